"""What keeps the stored star's merges cheap, with the same results."""
import contextlib
import io
import re
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from creditstats.functions import dates
from creditstats.incremental import star_store
from creditstats.operators import clean
from creditstats.schema import CREDIT_ITEMS, FILM_ITEMS, LONG_PAGE, MONEY, MOVIE, item_seq
from creditstats.streaming import star_stream

MOST = Decimal("999999.999999")


def _items(spark, films, credits):
    f = [(Decimal(s), None, film, "$1 million", box, date) for s, film, box, date in films]
    c = [(Decimal(s), None, film, kind, value) for s, film, kind, value in credits]
    return spark.createDataFrame(f, FILM_ITEMS).coalesce(1), spark.createDataFrame(c, CREDIT_ITEMS).coalesce(1)


def test_equal_values_of_an_entity_are_one_row(spark):
    """Before, each film of an entity was a row that every load rewrote."""
    store = star_store.open_store(spark, tempfile.mkdtemp(prefix="cs-store-"), 2)
    films = [(k, f"Film {k}", "$5 million", "2005") for k in range(4)] + [(4, "Film 4", "$9 million", "2005")]
    credits = [(10 + k, f"Film {k}", "actor", "Ann") for k in range(5)]
    star_store.apply(store, *_items(spark, films, credits), "log", 0, refresh=False)

    def counted():
        return sorted(map(tuple, store.read(store.manifest(), "credited").collect()))

    assert counted() == [("actor", "ann", 2005, Decimal(5), 4), ("actor", "ann", 2005, Decimal(9), 1)]
    # one film leaves the equal ones, another takes its place, the maximum goes
    changes = [(20, "Film 0", "$6 million", "2005"), (21, "Film 4", "$5 million", "2005"), (22, "Film 1", "$6 million", None)]
    star_store.apply(store, *_items(spark, changes, []), "log", 1)
    assert counted() == [("actor", "ann", 2005, Decimal(5), 4), ("actor", "ann", 2005, Decimal(6), 1)]
    (ann,) = star_store.read_report(store, "by_actor").collect()
    assert (ann.box_office_max, ann.box_office_min, ann.film_count) == (6, 5, 5)


def test_values_of_a_store_without_counts_stand_for_one_film(spark):
    """Stores written before hold a row a film: those rows have no n."""
    store = star_store.open_store(spark, tempfile.mkdtemp(prefix="cs-store-"), 1)
    films = [(1, "One", "$5 million", "2005"), (2, "Two", "$9 million", "2005")]
    star_store.apply(store, *_items(spark, films, [(3, "One", "actor", "Ann"), (4, "Two", "actor", "Ann")]), "log", 0, refresh=False)
    old = {**store.manifest(), "version": 2}
    rows = store.read(old, "credited").withColumn("n", F.lit(None).cast("bigint")).localCheckpoint()
    store.write(old, "credited", rows, [0])
    store.commit(old)
    star_store.apply(store, *_items(spark, [(5, "Two", "$1 million", "2005")], []), "log", 5)
    assert sorted(map(tuple, store.read(store.manifest(), "credited").select("box_office", "n").collect())) == [(1, 1), (5, 1)]
    (ann,) = star_store.read_report(store, "by_actor").collect()
    assert (ann.box_office_max, ann.box_office_min) == (5, 1)


def test_sums_of_whole_numbers_are_exact(spark):
    values = [MOST] * 1000 + [Decimal("0.000001"), Decimal("1048575.999999") - Decimal(100000), Decimal(0), Decimal("123456.654321")]
    rows = spark.createDataFrame([(v, s) for v in values for s in (1, 1, -1)], f"box_office {MONEY.simpleString()}, sign bigint")
    found = rows.groupBy().agg(*star_store._whole_sums(F.col("box_office"), F.col("sign"))).select(
        star_store._joined_sums("s1", 2), star_store._joined_sums("s2", 4)).first()
    whole = [int(v * 10 ** 6) for v in values]
    assert (int(found.s1), int(found.s2)) == (sum(whole), sum(m * m for m in whole))


def test_item_numbers_of_long_and_wide_pages(spark):
    pages = [0, 7, -7, LONG_PAGE, LONG_PAGE + 1, -LONG_PAGE - 1, 2 ** 63 - 1, None]
    found = spark.createDataFrame([(p,) for p in pages], "p bigint").select(item_seq(F.col("p"), 9, F.lit(10 ** 10 - 1)).alias("s"))
    assert dict(found.dtypes)["s"] == "decimal(38,0)"
    assert [None if r.s is None else int(r.s) for r in found.collect()] == [
        None if p is None else (p * 10 + 9) * 10 ** 10 + 10 ** 10 - 1 for p in pages]


def test_generated_methods_of_the_film_cleaning_are_compiled(spark):
    """The JVM interprets a method of over 8,000 bytes for good."""
    path = tempfile.mkdtemp(prefix="cs-films-") + "/films"
    _items(spark, [(1, "One", "$5 million", "2005")], [])[0].write.parquet(path)
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        clean.clean_film_items(spark.read.parquet(path)).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8000, sizes


def test_first_pattern_of_a_date_decides(spark):
    """In one pass, as when each pattern was tried after the other."""
    nbsp = " "
    texts = {
        "1999 May, then June 3, 2004": "2004-06-03", "3 June 2004 May 1, 2003": "2003-05-01", "x 2001 May 12 June 2004": "2004-06-12",
        f"May{nbsp}3,{nbsp}2004": "2004-05-03", "line\nMay 2004\nmore": "2004-05-01", "a|b|c 2004 May|1|2": "2004-05-01",
        "2004-5 2003-04-05": "2004-05-20", "5/2004": "2004-05-01", "in\u0001 2004": None, "2004|": "2004-01-01", "||": None, "a||": None,
        "P<Year>2004-May-3 xJune 2004": None, "$1 \\1 2004": "2004-01-01", "": None, None: None}
    rows = dates.with_release_date(spark.createDataFrame([(t,) for t in texts], "raw string"), "raw", "text", "reason").collect()
    assert {r.raw: r.text for r in rows} == texts


def test_films_of_a_batch_are_dealt_to_all_cores(spark, monkeypatch):
    """One file of a batch held all its films, and one task cleaned them."""
    films, credits = _items(spark, [(k, f"Film {k}", "$5 million", "2005") for k in range(50)], [(100, "Film 1", "actor", "Ann")])
    seen = []
    monkeypatch.setattr(star_stream.star_store, "apply", lambda store, f, c, *rest: seen.append(
        (f.rdd.getNumPartitions(), f.count(), c.count(), set(f.columns) - set(FILM_ITEMS.names))))
    star_stream.merge(tempfile.mkdtemp(prefix="cs-stream-"), 2)(star_stream.items(films, credits), 0)
    assert seen == [(spark.sparkContext.defaultParallelism, 50, 1, set())] and MOVIE == "movie"
