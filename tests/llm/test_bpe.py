import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from salesmart.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " ", "\t\n", "don't WE'LL i'm 'S", "a<|endoftext|>B <|startoftext|>", "< |endoftext|>", "日本語 中文 テスト",
       "Σίσυφος ΟΔΟΣ İstanbul ß ẞ", "été Å ﬁ", "😀👩‍👩‍👧 ♥️", "1234567890 ¼ ½ Ⅷ ३", "a b c\x85d\x1ce",
       "!!!???...### $$$ %%%", "x" * 5000, "ab" * 3000, "aaa aaaa aaaaa aaaaaaaa", "\x00\x01 \x7f", "<|", "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def library():
    t = Library.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_against_the_library(library):
    own = bpe.Tokenizer(bpe.read_spec(PATH))
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéèñüßçаβ日'#.0"
    texts = [t or "" for t in ODD] + [" ".join("".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(30)) for _ in range(300)]
    texts += ["".join(rng.choices("abn", k=rng.randint(1, 40))) for _ in range(300)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert own.decode(got).decode() == library.decode(want, skip_special_tokens=False), text


def test_every_code_point_against_the_library(library):
    own = bpe.Tokenizer(bpe.read_spec(PATH))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 400):
        chars = map(chr, points[at:at + 400])
        text = " ".join(f"a{c}b {c}1{c} !{c}{c}?" for c in chars)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, hex(points[at])


def test_cleared_tables_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_ENTRIES", 3)
    monkeypatch.setattr(bpe, "TRANSITIONS", 5)
    own = bpe.Tokenizer(bpe.read_spec(PATH))
    text = "these automaton tables are cleared again and again unbelievably often " * 3
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_columns_over_a_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(-i, t) for i, t in enumerate(ODD, 1)] * 2, docs.schema))
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        want[r.doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(),
                          hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    rows = bpe.digest(docs, PATH).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id]


def test_encode_decode_frames_with_clashing_columns(spark, library):
    docs = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "y")], "Ids int, text string, decoded string")
    tokens, names = bpe.encode(docs, PATH)
    assert names["ids"] == "ids_" and tokens.columns == ["Ids", "text", "decoded", "ids_"]
    back, name = bpe.decode(tokens, PATH, "ids_")
    assert name == "decoded_"
    assert {r.Ids: r.decoded_ for r in back.collect()} == {1: "hello</w> world</w>", 2: ""}
    assert bpe.encode(docs.limit(0), PATH)[0].count() == 0
