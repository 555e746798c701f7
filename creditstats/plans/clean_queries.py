"""Registered queries for the cleaning operators.

Each renders messy text from a whole driver table, with the style chosen
by a data attribute (day of week, order priority, part size), runs it
through the library's cleaning, and returns one row per input row. The
DuckDB oracle states the known clean value of every style instead of
repeating the regexes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..operators import clean
from ..sources.pages import release_date_choice
from ..sources.tables import table
from .driver_items import render_box_office

DOW_ORACLE = "dayofweek(o_orderdate)"  # DuckDB: Sunday = 0; Spark's dayofweek: Sunday = 1


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                        "o_orderpriority").withColumn("d", F.to_date("o_orderdate"))


def _film_items(df: DataFrame, release_date: Column, box_office: Column | None = None,
                film: Column | None = None) -> DataFrame:
    return df.select(
        F.col("o_orderkey").alias("seq"),
        F.lit(None).cast("bigint").alias("page_id"),
        (film if film is not None else F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))).alias("film"),
        F.lit(None).cast("string").alias("budget"),
        (box_office if box_office is not None else F.lit(None).cast("string")).alias("box_office"),
        release_date.alias("release_date"),
    )


# --- dates (C5-C11) -----------------------------------------------------------

def render_alpha_date(d: Column) -> Column:
    dow = F.dayofweek(d)
    return (
        F.when(dow == 1, F.date_format(d, "MMMM d, yyyy"))
        .when(dow == 2, F.concat(F.date_format(d, "d MMMM yyyy"), F.lit(" (United States)")))
        .when(dow == 3, F.date_format(d, "MMM d, yyyy"))
        .when(dow == 4, F.date_format(d, "MMMM yyyy"))
        .when(dow == 5, F.date_format(d, "yyyy MMMM"))
        .when(dow == 6, F.concat(F.date_format(d, "MMMM"), F.lit(" "), F.date_format(d, "d, yyyy")))
        # pattern order beats position: the later 'Month d, yyyy' wins
        .otherwise(F.concat(F.date_format(F.date_add(d, 400), "d MMMM yyyy"), F.lit(" to "),
                            F.date_format(d, "MMMM d, yyyy")))
    )


def render_numeric_date(d: Column) -> Column:
    dow = F.dayofweek(d)
    return (
        F.when(dow == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(dow == 2, F.date_format(d, "yyyy/M/d"))
        .when(dow == 3, F.date_format(d, "yyyy-MM"))
        .when(dow == 4, F.date_format(d, "MM/yyyy"))
        .when(dow == 5, F.date_format(d, "yyyy"))
        .when(dow == 6, F.date_format(d, "yyyy M d"))
        # US month/day/year: the month-year rule reads the day digits as the month
        .otherwise(F.date_format(d, "MM/dd/yyyy"))
    )


def _parsed(df: DataFrame, text_col: str) -> DataFrame:
    out = dates.with_release_date(df, text_col, "_t", "_r")
    return out.withColumn("release_date", dates.to_date_checked(F.col("_t")))


def parse_date_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders(spark, sf_dir).withColumn("raw", render_alpha_date(F.col("d")))
    return _parsed(df, "raw").select("o_orderkey", "release_date")


def parse_date_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders(spark, sf_dir).withColumn("raw", render_numeric_date(F.col("d")))
    return _parsed(df, "raw").select("o_orderkey", "release_date")


def parse_date_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both families through one parser: the lowercase test dispatches."""
    o = _orders(spark, sf_dir)
    df = o.select("o_orderkey", F.explode(F.array(
        F.struct(F.lit("alpha").alias("family"), render_alpha_date(F.col("d")).alias("raw")),
        F.struct(F.lit("numeric").alias("family"), render_numeric_date(F.col("d")).alias("raw")),
    )).alias("x")).select("o_orderkey", "x.family", "x.raw")
    return _parsed(df, "raw").select("o_orderkey", "family", "release_date")


def date_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8, C11 and the DATE domain: why each film item is lost, if it is."""
    o = _orders(spark, sf_dir)
    d, pr = F.col("d"), F.col("o_orderpriority")
    raw = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .when(pr == "1-URGENT", F.concat(F.lit("Summer "), F.date_format(d, "yyyy")))
        .when(pr == "2-HIGH", F.lit("TBA"))
        .when(pr == "3-MEDIUM", F.concat(F.lit("("), F.date_format(d, "yyyy"), F.lit(")")))
        .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("February 30, "), F.date_format(d, "yyyy")))
        .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-13-"), F.date_format(d, "dd")))
    )
    cleaned = clean.clean_film_items(_film_items(o, raw))
    return cleaned.select(F.col("seq").alias("o_orderkey"), "reason")


def strip_parens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 on decorated part names: first '(' to last ')', at least one char."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    size, name = F.col("p_size"), F.col("p_name")
    raw = (
        F.when(size <= 10, F.concat(name, F.lit(" ("), F.col("p_brand"), F.lit(")")))
        .when(size <= 20, F.concat(F.lit("("), F.col("p_type"), F.lit(") "), name))
        .when(size <= 30, F.concat(name, F.lit(" ()")))
        .when(size <= 40, F.concat(name, F.lit(" (a) and (b)")))
        .otherwise(name)
    )
    return p.select("p_partkey", F.regexp_replace(raw, dates.PAREN_PATTERN, "").alias("stripped"))


# --- money (C12-C17, L11) ------------------------------------------------------

def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    raw = F.when(F.col("o_orderstatus") != "P", render_box_office(F.col("o_totalprice"), F.col("o_orderpriority")))
    return money.with_money(o.select("o_orderkey", raw.alias("raw")), "raw", "box_office", "_bad").select(
        "o_orderkey", "box_office")


def parse_money_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    p = F.col("o_totalprice").cast("decimal(12,2)")
    k = F.lit(0.001).cast("decimal(4,3)")
    pr = F.col("o_orderpriority")
    s = lambda c: c.cast("string")
    raw = (
        F.when(pr == "1-URGENT", F.concat(F.lit("$"), s(p - 1), F.lit("-"), s(p + 1), F.lit(" million")))
        .when(pr == "2-HIGH", F.concat(F.lit("$"), s((p - 1) * k), F.lit("—"), s((p + 1) * k), F.lit(" billion")))
        # spaces around the dash: not a range, the first number counts
        .when(pr == "3-MEDIUM", F.concat(F.lit("$"), s(p - 2), F.lit(" - "), s(p + 2), F.lit(" million")))
        # 'million' is tested before 'billion' and the dash has no digit after it
        .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("$"), s(p), F.lit(" million–$"), s(p * k), F.lit(" billion")))
        .otherwise(F.concat(F.lit("$"), F.format_number((p - 1) * 1000000, 0), F.lit("–"),
                            F.format_number((p + 1) * 1000000, 0)))
    )
    return money.with_money(o.select("o_orderkey", raw.alias("raw")), "raw", "box_office", "_bad").select(
        "o_orderkey", "box_office")


def domain_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that do not fit DECIMAL(12,6) and impossible numeric
    dates reject the whole film item; the rest pass."""
    o = _orders(spark, sf_dir)
    p = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    pr, d = F.col("o_orderpriority"), F.col("d")
    box = (
        F.when(pr == "1-URGENT", F.concat(F.lit("$"), p, F.lit(" billion")))
        .when(pr == "2-HIGH", F.concat(F.lit("$"), (F.col("o_totalprice").cast("decimal(12,2)") * 10).cast("string"),
                                       F.lit(" million")))
        .otherwise(F.concat(F.lit("$"), p, F.lit(" million")))
    )
    date = F.when(pr == "3-MEDIUM", F.concat(F.date_format(d, "yyyy-MM"), F.lit("-32"))).otherwise(
        F.date_format(d, "yyyy-MM-dd"))
    cleaned = clean.clean_film_items(_film_items(o, date, box))
    return cleaned.select(F.col("seq").alias("o_orderkey"), "box_office", "reason")


def require_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 (film title present) and C4 (release date present)."""
    o = _orders(spark, sf_dir)
    pending, pr = F.col("o_orderstatus") == "P", F.col("o_orderpriority")
    title = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    film = (F.when(pending & (pr == "1-URGENT"), F.lit(None).cast("string"))
            .when(pending & (pr == "2-HIGH"), F.lit("")).otherwise(title))
    date = (F.when(pending & (pr == "3-MEDIUM"), F.lit(None).cast("string"))
            .when(pending & (pr == "4-NOT SPECIFIED"), F.lit(""))
            .otherwise(F.date_format(F.col("d"), "MMMM d, yyyy")))
    cleaned = clean.clean_film_items(_film_items(o, date, film=film))
    return cleaned.select(F.col("seq").alias("o_orderkey"), "reason")


# --- names (C2, C3, X11) -------------------------------------------------------

def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")


def decorate_junk(name: Column, size: Column) -> Column:
    return (
        F.when(size <= 5, F.concat(F.lit("("), name, F.lit(")")))
        .when(size <= 10, F.concat(name, F.lit(" (voice)")))
        .when(size <= 15, F.concat(name, F.lit(" (voice) extra")))
        .when(size <= 20, F.concat(name, F.lit(" [1]")))
        .when(size <= 25, F.concat(F.lit("{"), name, F.lit("}")))
        .when(size <= 30, F.concat(name, F.lit(" (bar")))
        .when(size <= 35, F.concat(F.lit("[a] "), name, F.lit(" [b]")))
        .when(size <= 40, F.lit("- ,"))
        .otherwise(name)
    )


def drop_junk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir).withColumn("value", decorate_junk(F.col("p_name"), F.col("p_size")))
    return p.where(~text.is_junk_name(F.col("value"))).select("p_partkey", "value")


def strip_leading_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, name = F.col("p_size"), F.col("p_name")
    raw = (
        F.when(size <= 10, F.concat(F.lit(", "), name))
        .when(size <= 20, F.concat(F.lit("/"), name))
        .when(size <= 30, F.concat(F.lit(",/,"), name))
        .when(size <= 40, F.concat(F.lit("-"), name))
        .otherwise(F.concat(F.lit(" ,"), name))
    )
    return _parts(spark, sf_dir).select("p_partkey", text.strip_leading_punct(raw).alias("value"))


def strip_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, name = F.col("p_size"), F.col("p_name")
    raw = (
        F.when(size <= 10, F.concat(F.lit(" "), name, F.lit("\n")))
        .when(size <= 20, F.concat(F.lit("　 "), name, F.lit("\t")))
        .when(size <= 30, F.lit("  \n"))
        .otherwise(name)
    )
    v = text.strip_ws(raw)
    return _parts(spark, sf_dir).select("p_partkey", v.alias("value")).where(text.nonempty(F.col("value")))


# --- candidate choice (X4, X8) -------------------------------------------------

def first_valid_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    pr, d = F.col("o_orderpriority"), F.col("d")
    full = F.date_format(d, "MMMM d, yyyy")
    c1 = (F.when(pr == "1-URGENT", F.lit("(United States)"))
          .when(pr == "2-HIGH", F.concat(full, F.lit(" (United States)"))))
    c2 = F.when(pr == "3-MEDIUM", F.lit("TBA")).when(pr == "4-NOT SPECIFIED", full)
    c3 = F.date_format(d, "yyyy")
    c4 = full
    return o.select("o_orderkey", release_date_choice(F.array(c1, c2, c3, c4)).alias("release_text"))


REGISTRY = {
    "parse_date_alpha": parse_date_alpha,
    "parse_date_numeric": parse_date_numeric,
    "parse_date_mixed": parse_date_mixed,
    "date_rejects": date_rejects,
    "strip_parens": strip_parens,
    "parse_money": parse_money,
    "parse_money_range": parse_money_range,
    "domain_rejects": domain_rejects,
    "require_field": require_field,
    "drop_junk_names": drop_junk_names,
    "strip_leading_punct": strip_leading_punct,
    "strip_nonempty": strip_nonempty,
    "first_valid_candidate": first_valid_candidate,
}

# --- oracles -------------------------------------------------------------------

_D = "CAST(o_orderdate AS DATE)"
_M1 = f"CAST(date_trunc('month', o_orderdate) AS DATE)"
_P = "CAST(o_totalprice AS DECIMAL(12,6))"

_ALPHA_EXPECTED = f"CASE WHEN {DOW_ORACLE} IN (3, 4) THEN {_M1} ELSE {_D} END"
_NUMERIC_EXPECTED = f"""CASE {DOW_ORACLE}
    WHEN 2 THEN {_M1} WHEN 3 THEN {_M1}
    WHEN 4 THEN make_date(year(o_orderdate), 1, 1)
    WHEN 6 THEN CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), 1)
                     WHEN day(o_orderdate) < 20 OR day(o_orderdate) % 10 = 0 THEN NULL
                     ELSE make_date(year(o_orderdate), day(o_orderdate) % 10, 1) END
    ELSE {_D} END"""

ORACLES = {
    "parse_date_alpha": f"SELECT o_orderkey, {_ALPHA_EXPECTED} AS release_date FROM orders",
    "parse_date_numeric": f"SELECT o_orderkey, {_NUMERIC_EXPECTED} AS release_date FROM orders",
    "parse_date_mixed": f"""
SELECT o_orderkey, 'alpha' AS family, {_ALPHA_EXPECTED} AS release_date FROM orders
UNION ALL
SELECT o_orderkey, 'numeric' AS family, {_NUMERIC_EXPECTED} AS release_date FROM orders""",
    "date_rejects": """
SELECT o_orderkey, CASE
    WHEN o_orderstatus = 'P' THEN 'release_date_missing'
    WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'release_date_month_or_day_invalid'
    WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'release_date_unmatched'
    ELSE 'out_of_domain' END AS reason
FROM orders""",
    "strip_parens": """
SELECT p_partkey, CASE
    WHEN p_size <= 10 THEN p_name || ' '
    WHEN p_size <= 20 THEN ' ' || p_name
    WHEN p_size <= 30 THEN p_name || ' ()'
    WHEN p_size <= 40 THEN p_name || ' '
    ELSE p_name END AS stripped
FROM part""",
    "parse_money": f"SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {_P} END AS box_office FROM orders",
    "parse_money_range": f"""
SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM'
    THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) - 2 AS DECIMAL(12,6)) ELSE {_P} END AS box_office
FROM orders""",
    "domain_rejects": f"""
SELECT o_orderkey,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
         WHEN o_orderpriority = '2-HIGH' THEN
              CASE WHEN o_totalprice * 10 < 1000000 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 10 AS DECIMAL(12,6)) END
         ELSE {_P} END AS box_office,
    CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'out_of_domain'
         WHEN o_orderpriority = '2-HIGH' AND o_totalprice * 10 >= 1000000 THEN 'out_of_domain'
         END AS reason
FROM orders""",
    "require_field": """
SELECT o_orderkey, CASE
    WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'film_missing'
    WHEN o_orderstatus = 'P' AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'release_date_missing'
    END AS reason
FROM orders""",
    "drop_junk_names": """
SELECT p_partkey, CASE
    WHEN p_size <= 15 THEN p_name || ' (voice) extra'
    WHEN p_size <= 20 THEN p_name || ' [1]'
    WHEN p_size <= 30 THEN p_name || ' (bar'
    WHEN p_size <= 40 THEN '- ,'
    ELSE p_name END AS value
FROM part
WHERE NOT (p_size <= 10 OR p_size BETWEEN 21 AND 25 OR p_size BETWEEN 31 AND 35)""",
    "strip_leading_punct": """
SELECT p_partkey, CASE
    WHEN p_size <= 10 THEN ' ' || p_name
    WHEN p_size <= 30 THEN p_name
    WHEN p_size <= 40 THEN '-' || p_name
    ELSE ' ,' || p_name END AS value
FROM part""",
    "strip_nonempty": "SELECT p_partkey, p_name AS value FROM part WHERE NOT (p_size BETWEEN 21 AND 30)",
    "first_valid_candidate": """
SELECT o_orderkey, CASE
    WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%B ') || CAST(day(o_orderdate) AS VARCHAR)
         || strftime(o_orderdate, ', %Y') || ' (United States)'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%B ') || CAST(day(o_orderdate) AS VARCHAR)
         || strftime(o_orderdate, ', %Y')
    ELSE strftime(o_orderdate, '%Y') END AS release_text
FROM orders""",
}
