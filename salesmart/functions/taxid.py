"""Check-digit validation of a 14-digit company tax id as a Column expression.

Digits are read with ``substring`` and weighted sums are taken with
``aggregate`` over a literal weight array, so the check stays inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TAX_ID_WEIGHTS_1, TAX_ID_WEIGHTS_2


def _weighted_sum(digits: str, weights: list[int]) -> Column:
    terms = [F.substring(F.col(digits), i + 1, 1).cast("int") * F.lit(w) for i, w in enumerate(weights)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _check_digit(remainder: Column) -> Column:
    return F.when(remainder < 2, F.lit(0)).otherwise(F.lit(11) - remainder)


def tax_id_is_valid(col: str) -> Column:
    """True when ``col`` is 14 digits with both check digits right; False otherwise (never NULL)."""
    well_formed = F.coalesce(F.col(col).rlike(r"^[0-9]{14}$"), F.lit(False))
    d1 = _check_digit(F.pmod(_weighted_sum(col, TAX_ID_WEIGHTS_1), F.lit(11)))
    # the second sum covers the 12 base digits plus the first check digit
    s2 = _weighted_sum(col, TAX_ID_WEIGHTS_2[:12]) + d1 * F.lit(TAX_ID_WEIGHTS_2[12])
    d2 = _check_digit(F.pmod(s2, F.lit(11)))
    given1 = F.substring(F.col(col), 13, 1).cast("int")
    given2 = F.substring(F.col(col), 14, 1).cast("int")
    return F.when(well_formed, (given1 == d1) & (given2 == d2)).otherwise(F.lit(False))
