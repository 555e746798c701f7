from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from creditstats.functions import dates, money, text

NBSP = " "


def _one_col(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


NAME_CASES = [
    ("(voice)", None),
    ("Foo (bar)", None),
    ("Foo (bar) Baz", "Foo (bar) Baz"),
    ("Foo (bar", "Foo (bar"),
    ("[1]", None),
    ("Foo [1]", "Foo [1]"),
    ("Foo {x}", None),
    ("[a] b", "[a] b"),
    ("[a] b [c]", None),
    ("A) B", "A) B"),
    (", Foo", " Foo"),
    ("/Foo", "Foo"),
    ("-Foo", "-Foo"),
    ("&", "&"),
    (".", "."),
    ("- ,", "- ,"),
]


def test_name_cleaning(spark):
    df = _one_col(spark, [c[0] for c in NAME_CASES])
    out = df.select(
        "i", F.when(~text.is_junk_name(F.col("v")), text.strip_leading_punct(F.col("v"))).alias("o")
    ).orderBy("i").collect()
    assert [r.o for r in out] == [c[1] for c in NAME_CASES]


def test_strip_ws_matches_python(spark):
    vals = ["  a b \n", f"{NBSP}x{NBSP}", " y　", "\x1cz\x1f", "", "  ", "​q"]
    df = _one_col(spark, vals)
    out = [r.o for r in df.select("i", text.strip_ws(F.col("v")).alias("o")).orderBy("i").collect()]
    assert out == [v.strip() for v in vals]


def test_name_key(spark):
    df = _one_col(spark, ["Beyoncé", "BEYONCE", "beyonce ", " beyonce", "Zoë", "Œuvre"])
    out = [r.k for r in df.select("i", text.name_key(F.col("v")).alias("k")).orderBy("i").collect()]
    assert out[0] == out[1] == out[2] == "beyonce"
    assert out[3] == " beyonce"
    assert out[4] == "zoe"
    assert out[5] == "œuvre"


DATE_CASES = [
    (f"March{NBSP}4, 2005", date(2005, 3, 4)),
    ("4 March 2005", date(2005, 3, 4)),
    ("Dec 25, 2005", date(2005, 12, 25)),
    ("March 2005", date(2005, 3, 1)),
    (f"March{NBSP}2005", dates.REASON_UNMATCHED),
    ("2005 March 4", date(2005, 3, 1)),
    ("2005-March-04", date(2005, 3, 1)),
    ("5 May 2006 to April 1, 2004", date(2004, 4, 1)),
    ("March 4, 2005 (New York) and May 6, 2006 (US)", date(2005, 3, 4)),
    ("Dec. 25, 2005", dates.REASON_UNMATCHED),
    ("Spring", dates.REASON_UNMATCHED),
    ("Sept 5, 2005", dates.REASON_BAD_WORD_OR_DAY),
    ("Summer 2005", dates.REASON_BAD_WORD_OR_DAY),
    ("February 30, 2005", dates.REASON_BAD_WORD_OR_DAY),
    ("2005-03-04", date(2005, 3, 4)),
    ("2005/3/4", date(2005, 3, 4)),
    ("2005-03", date(2005, 3, 1)),
    ("03/2005", date(2005, 3, 1)),
    ("2005", date(2005, 1, 1)),
    ("20050304", date(2005, 1, 1)),
    ("TBA 2005", date(2005, 1, 1)),
    ("MARCH 4, 2005", date(2005, 1, 1)),
    ("12/10/2005", date(2005, 10, 1)),
    ("12/25/2005", date(2005, 5, 1)),
    ("12/20/2005", "2005-00-01"),
    ("2005-2006", date(2005, 2, 1)),
    ("2005-13-40", "2005-13-04"),
    ("(2005)", dates.REASON_UNMATCHED),
    (None, dates.REASON_MISSING),
    ("", dates.REASON_MISSING),
    ("P<Year>2005-March-04", dates.REASON_UNMATCHED),
]


def test_dates(spark):
    df = dates.with_release_date(_one_col(spark, [c[0] for c in DATE_CASES]), "v", "t", "r")
    out = df.select("i", "t", "r", dates.to_date_checked(F.col("t")).alias("d")).orderBy("i").collect()
    for (raw, exp), r in zip(DATE_CASES, out):
        if isinstance(exp, date):
            assert r.d == exp and r.r is None, (raw, r)
        elif exp.startswith("release_date"):
            assert r.r == exp and r.t is None, (raw, r)
        else:  # produced text, rejected by the DATE column
            assert r.t == exp and r.r is None and r.d is None, (raw, r)


MONEY_CASES = [
    ("$150 million", "150.000000"),
    ("$1.5 billion", "1500.000000"),
    ("$100–120 million", "110.000000"),
    ("$1.2—1.5 billion", "1350.000000"),
    ("$3,000,000-5,000,000", "4.000000"),
    ("$10 - 20 million", "10.000000"),
    ("$800 million–$1.2 billion", "800.000000"),
    ("$1 million to $2 billion", "1.000000"),
    ("$45,000", "0.045000"),
    ("$123,456,789", "123.456789"),
    ("500 thousand", "0.000500"),
    ("1 MILLION", "0.000001"),
    ("US$.5 million", "5.000000"),
    ("£5 million", "5.000000"),
    ("million", "1.000000"),
    ("unknown", "0.000001"),
    ("\n", "0.000001"),
    ("$2,000,000,000,000", "REJECT"),
    ("$5\\xa0million", "5.000000"),
    (None, None),
    ("", "REJECT"),
]


def test_money(spark):
    df = _one_col(spark, [c[0] for c in MONEY_CASES])
    out = df.select("i", money.clean_money(F.col("v")).alias("m"),
                    money.money_out_of_domain(F.col("v")).alias("bad")).orderBy("i").collect()
    for (raw, exp), r in zip(MONEY_CASES, out):
        if exp == "REJECT":
            assert r.bad and r.m is None, (raw, r)
        elif exp is None:
            assert r.m is None and not r.bad, (raw, r)
        else:
            assert r.m == Decimal(exp) and not r.bad, (raw, r)
