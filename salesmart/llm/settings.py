"""Production parameters that the queries and the pipeline share."""

from __future__ import annotations

import os

#: Key of the surrogate draw; a deployment sets its own.
PII_KEY = os.environ.get("SALESMART_PII_KEY", "surrogate-key")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file; the driver reads it and broadcasts what executors need."""
    import public_tokenizers

    return public_tokenizers.path(name)
