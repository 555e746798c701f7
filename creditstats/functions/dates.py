"""Release-date cleaning as native Column expressions.

Every parse is a try_* function, so nothing raises under ANSI mode. The
outcome of one raw text is a struct (text, reason):

  text    'yyyy-MM-dd' string, or null
  reason  null when a date text was produced, else why the item is lost

Rules, in order: remove the first '(' .. last ')' span; if any lowercase
ASCII letter is left, try the alphabetic patterns, else the numeric ones.
The FIRST PATTERN (not the first position) that matches anywhere decides;
later patterns are not tried even when the chosen one fails to parse.
Alphabetic dates are calendar-checked here (an invalid month word or day
loses the item); numeric dates are not, they are rejected at the write
(see operators.model) as the reference's DATE column does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WS_CLASS

S = WS_CLASS  # Python's \s in a str pattern is Unicode whitespace

# ---------------------------------------------------------------------------
# The reference's date patterns, in their order of priority.
# Alphabetic (group order noted per pattern):
# Alpha: month day, year; day month year; a literal form that loses the item;
# year month; month year. Numeric: year month day; year month; month year;
# year. Month words: full English name, else the 3-letter abbreviation.
PAREN_PATTERN = r"(?d)\(.+\)"
ALPHA_MDY = f"([A-Z][a-z]+){S}([0-3][0-9]|[0-9]),{S}([0-9]{{4}})"
ALPHA_DMY = f"([0-3][0-9]|[0-9]){S}([A-Z][a-z]+){S}([0-9]{{4}})"
ALPHA_YMD_LITERAL = r"P<Year>[0-9]{4}[/\-][A-Z][a-z]+[/\-](?:[0-3][0-9]|[0-9])"
ALPHA_YM = r"([0-9]{4})[/\- ]([A-Z][a-z]+)"
ALPHA_MY = r"([A-Z][a-z]+)[/\- ]([0-9]{4})"
NUM_YMD = r"([0-9]{4})[/\- ]([0-1][0-9]|[0-9])[/\- ]([0-3][0-9]|[0-9])"
NUM_YM = r"([0-9]{4})[/\- ]([0-1][0-9]|[0-9])"
NUM_MY = r"([0-1][0-9]|[0-9])[/\- ]([0-9]{4})"
NUM_Y = r"([0-9]{4})"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# ---------------------------------------------------------------------------

REASON_MISSING = "release_date_missing"
REASON_UNMATCHED = "release_date_unmatched"
REASON_BAD_WORD_OR_DAY = "release_date_month_or_day_invalid"
REASON_BAD_DATE = "release_date_out_of_domain"


def _pad2(c: Column) -> Column:
    return F.lpad(c, 2, "0")


_ANY = r"[\s\S]*"


def _first_of(*patterns: str) -> str:
    """A pattern over the whole text that takes the first match of the first
    of `patterns` that has one; of texts with none it takes no group. (One
    pass and little code: a test and an extraction a pattern and group made a
    generated method too large to be compiled.)"""
    return rf"\A(?:{'|'.join(f'{_ANY}?{p}{_ANY}' for p in patterns)}|{_ANY})\z"


# The groups of each pattern, in its order, as year|month|day.
_ALPHA, _ALPHA_PARTS = _first_of(ALPHA_MDY, ALPHA_DMY, ALPHA_YMD_LITERAL, ALPHA_YM, ALPHA_MY), "$3$6$7$10|$1$5$8$9|$2$4"
_NUM, _NUM_PARTS = _first_of(NUM_YMD, NUM_YM, NUM_MY, NUM_Y), "$1$4$7$8|$2$5$6|$3"


def _pick(s: Column) -> Column:
    """struct(alpha, parts): the branch chosen by the lowercase test, and
    year, month and day of the first matching pattern, empty where it has
    none."""
    alpha = s.rlike("[a-z]")
    parts = F.when(alpha, F.regexp_replace(s, _ALPHA, _ALPHA_PARTS)).otherwise(F.regexp_replace(s, _NUM, _NUM_PARTS))
    return F.struct(F.coalesce(alpha, F.lit(False)).alias("alpha"), F.split(parts, r"\|").alias("parts"))


def _picked(p: Column) -> Column:
    """struct(alpha, y, m, d) of what `_pick` found; y is null when nothing
    matched (or when the literal-'P<Year>' pattern matched, which loses the
    item too)."""
    y, m, d = (F.get(p["parts"], k) for k in range(3))
    return F.struct(p["alpha"].alias("alpha"), F.when(y != "", y).alias("y"), F.when(m != "", m).otherwise("01").alias("m"),
                    F.when(d != "", d).otherwise("01").alias("d"))


def _month_number(word: Column) -> Column:
    """Full English month name, else its 3-letter abbreviation -> 1..12;
    null for any other word."""
    m = F.lit(None).cast("int")
    for i in range(12, 0, -1):
        m = F.when(word.isin(MONTHS[i - 1], MONTH_ABBREVIATIONS[i - 1]), F.lit(i)).otherwise(m)
    return m


def _alpha_date(p: Column) -> Column:
    """Month-word parse of a picked alphabetic date; null for an unknown
    word or an impossible day. A table lookup and a date cast: no
    formatter and no exceptions on the failure path. Year 0 is a date in
    Spark's calendar but not in Python's."""
    # concat (not concat_ws): an unknown month word must null the text
    iso = F.concat(p["y"], F.lit("-"), _pad2(_month_number(p["m"]).cast("string")), F.lit("-"), _pad2(p["d"]))
    return F.when(p["alpha"] & p["y"].isNotNull() & (p["y"] != "0000"), iso.try_cast("date"))


def _outcome(raw: Column, p: Column, alpha_date: Column) -> tuple[Column, Column]:
    missing = raw.isNull() | (raw == "")
    text = (
        F.when(missing, F.lit(None).cast("string"))
        .when(p["alpha"], alpha_date.cast("string"))
        .when(p["y"].isNotNull(), F.concat_ws("-", p["y"], _pad2(p["m"]), _pad2(p["d"])))
    )
    reason = (
        F.when(missing, F.lit(REASON_MISSING))
        .when(p["y"].isNull(), F.lit(REASON_UNMATCHED))
        .when(p["alpha"] & alpha_date.isNull(), F.lit(REASON_BAD_WORD_OR_DAY))
    )
    return text, reason


def with_release_date(df: DataFrame, raw: str, text_col: str, reason_col: str) -> DataFrame:
    """Add the cleaned date text and the loss reason as columns.

    Staged as separate projections (parenthesis removal, pattern pick,
    month-word parse), each referenced by column: every regex runs once per
    row and the generated code stays small enough for whole-stage codegen."""
    s, p, a = "__rd_s", "__rd_p", "__rd_a"
    out = df.withColumn(s, F.regexp_replace(F.col(raw), PAREN_PATTERN, ""))
    out = out.withColumn(p, _pick(F.col(s)))
    out = out.withColumn(p, _picked(F.col(p)))
    out = out.withColumn(a, _alpha_date(F.col(p)))
    text, reason = _outcome(F.col(raw), F.col(p), F.col(a))
    return out.withColumn(text_col, text).withColumn(reason_col, reason).drop(s, p, a)


def to_date_checked(text: Column) -> Column:
    """The DATE column's domain check: null for impossible dates. The text
    is always zero-padded yyyy-MM-dd here, so a cast reads it."""
    return text.try_cast("date")
