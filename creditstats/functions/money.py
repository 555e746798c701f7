"""Money cleaning to millions of dollars as native Column expressions
(C12-C17).

Arithmetic is exact decimal (not binary float): numbers are read as
decimal(30,10), a range gives its midpoint, and the unit scale is applied
by multiplication. The result is try_cast to decimal(12,6), the width of
the reference's money columns; a value that does not fit comes back null
while the raw text was present, which the model treats as a rejected
write (L11). Known deviation: an exact half at the 7th decimal rounds up
here, while the reference's float formatting may round it down.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(12,6)"
WORK_TYPE = "decimal(30,10)"

# ---------------------------------------------------------------------------
# The reference's money rules.
# Noise, ranges, single numbers (none found counts as 1) and units: million
# is tested first, then billion; anything else is dollars.
NOISE_PATTERN = r"\\xa0|\$|,"
RANGE_PATTERN = "([0-9]+\\.[0-9]+|[0-9]+)[-\u2013\u2014]([0-9]+\\.[0-9]+|[0-9]+)"
NUMBER_PATTERN = r"[0-9]+\.[0-9]+|[0-9]+"
MILLION_PATTERN = "million|Million"
BILLION_PATTERN = "billion|Billion"
# ---------------------------------------------------------------------------

_HALF = Decimal("0.5")
_THOUSAND = Decimal("1000")
_MICRO = Decimal("0.000001")


def _amount_from_clean(s: Column) -> Column:
    """Amount in millions from noise-free text `s` (decimal, unbounded)."""
    has_range = s.rlike(RANGE_PATTERN)
    lo = F.regexp_extract(s, RANGE_PATTERN, 1).try_cast(WORK_TYPE)
    hi = F.regexp_extract(s, RANGE_PATTERN, 2).try_cast(WORK_TYPE)
    single = F.regexp_extract(s, NUMBER_PATTERN, 0)
    # No number at all counts as 1; a number too long for the work type
    # stays null (unreadable), which later fails the width check.
    number = (
        F.when(has_range, (lo + hi) * F.lit(_HALF))
        .when(single == "", F.lit(Decimal(1)).cast(WORK_TYPE))
        .otherwise(single.try_cast(WORK_TYPE))
    )
    return (
        F.when(s.rlike(MILLION_PATTERN), number)
        .when(s.rlike(BILLION_PATTERN), number * F.lit(_THOUSAND))
        .otherwise(number * F.lit(_MICRO))
    )


def money_amount(raw: Column) -> Column:
    """Raw money text -> amount in millions before the width check; null
    for null/empty input (not cleaned) or an unreadable number."""
    return F.when(raw.isNotNull() & (raw != ""), _amount_from_clean(F.regexp_replace(raw, NOISE_PATTERN, "")))


def clean_money(raw: Column) -> Column:
    """Raw money text -> decimal(12,6) millions, null when absent or when it
    does not fit the column (see money_out_of_domain)."""
    return money_amount(raw).try_cast(MONEY_TYPE)


def money_out_of_domain(raw: Column) -> Column:
    """True when the raw text was present but its value cannot be stored.
    An empty string is present too: the reference skips cleaning it and
    the DECIMAL column refuses it."""
    return raw.isNotNull() & clean_money(raw).isNull()


def with_money(df: DataFrame, raw: str, value_col: str, bad_col: str) -> DataFrame:
    """Staged form of clean_money + money_out_of_domain: the noise removal
    runs once per row and is referenced by column."""
    s = f"__m_{value_col}"
    r = F.col(raw)
    out = df.withColumn(s, F.regexp_replace(r, NOISE_PATTERN, ""))
    out = out.withColumn(value_col, F.when(r.isNotNull() & (r != ""), _amount_from_clean(F.col(s)))
                         .try_cast(MONEY_TYPE))
    return out.withColumn(bad_col, r.isNotNull() & F.col(value_col).isNull()).drop(s)
