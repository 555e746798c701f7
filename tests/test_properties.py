"""Property tests: the cleaners never raise under ANSI mode,
a date is either null with a reason or valid without one, money is never
negative, and replaying the item log changes nothing."""
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditstats.functions import dates, money, text
from creditstats.operators import clean, model

ALPHABET = st.sampled_from(list("0123456789 ,.-–—/$()[]{}:;!+ abcMJSDFNOAeyrhulgptvmi\n ") +
                           ["March", "May", "Sept", "Dec", "million", "billion", "Million", "\\xa0", "US", "2005"])
TEXTS = st.lists(st.one_of(st.none(), st.lists(ALPHABET, max_size=12).map("".join)), min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(TEXTS)
def test_dates_total_and_valid(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = dates.with_release_date(df, "v", "t", "r").select(
        "v", "t", "r", dates.to_date_checked(F.col("t")).alias("d")).collect()
    for row in out:
        assert (row.t is None) == (row.r is not None), row
        if row.d is not None:
            assert isinstance(row.d, date) and row.t == row.d.isoformat()


@SETTINGS
@given(TEXTS)
def test_money_total_and_nonnegative(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = money.with_money(df, "v", "m", "bad").collect()
    for row in out:
        if row.m is not None:
            assert row.m >= 0
        assert row.bad == (row.v is not None and row.m is None)


@SETTINGS
@given(TEXTS)
def test_names_total(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select(text.is_junk_name(F.col("v")).alias("j"), text.strip_ws(F.col("v")).alias("s"),
                    text.name_key(F.col("v")).alias("k"), "v").collect()
    for row in out:
        if row.v is not None:
            assert row.s == row.v.strip()
            assert row.k is not None


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["Ann", "ANN", "ann ", "Bo", "(x)", ", Cy"])),
                min_size=1, max_size=30))
def test_replay_is_idempotent(spark, pairs):
    rows = [(i, None, f"Film {f}", "actor", v) for i, (f, v) in enumerate(pairs)]
    c = spark.createDataFrame(rows, "seq long, page_id long, film string, kind string, value string")
    once = clean.clean_credit_items(c)
    twice = clean.clean_credit_items(c.unionByName(c))
    assert sorted(model.build_bridges(once).collect()) == sorted(model.build_bridges(twice).collect())
    assert sorted(model.build_dimensions(once).collect()) == sorted(model.build_dimensions(twice).collect())


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(list("[](){},;!:+-/ab \n")), max_size=9).map("".join), min_size=1, max_size=60))
def test_junk_test_equals_the_replacement(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(text.is_junk_name(F.col("v")).alias("j"),
                     (F.regexp_replace("v", text.JUNK_PATTERN, "") == "").alias("want"), "v").collect()
    assert [(r.v, r.j) for r in rows] == [(r.v, r.want) for r in rows]


def test_junk_test_is_linear(spark):
    import time
    values = ["[" + "n" * 400_000, "[" * 400_000, "(" * 400_000 + "x\n", ")" * 400_000 + "x", "," * 400_000 + "x"]
    began = time.time()
    assert [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string")
            .select(text.is_junk_name(F.col("v"))).collect()] == [False] * 5
    assert time.time() - began < 20
