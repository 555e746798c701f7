"""The star schema and its reports, kept up to date.

`apply` merges a batch of items into the stored tables: the same rows as one
load of all items so far, but only the buckets of the batch's keys are read
and written, and the reports are refreshed from mergeable state.

  movies      movie_key: id, first spelling (with its seq), latest facts (with their seq)
  dimensions  kind, entity_key: id, first spelling
  bridges     movie_key: credited pairs
  credited    kind, entity_key: per release year and box office, of how many films it is
  state       kind, entity_key: per release year n, s1, s2 (sums of the box
              office in millionths and of its square), most, least

Ids are dense: a new key gets the next number of its table in order of first
arrival, and keeps it (the ledger of the last numbers is in the manifest).

View maintenance: a film whose box office or year changes retracts its old
value from all its entities and adds the new one; a new pair adds the film's
value. `credited` counts an entity's equal values, so additions and
retractions are summed there alike, and what goes and comes back never moves.
n, s1 and s2 are added up with their signs. The maximum and minimum of
a group change by its additions alone, unless a retracted value was the
maximum or minimum: only such groups are read again from `credited`.

Each batch has a source and a position in it; positions only rise, and one
that is already in the manifest is skipped, so a repeated batch changes
nothing.
"""

from __future__ import annotations

import os
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators import clean, model, reports
from ..operators.ordering import row_number_global
from ..operators.partitioning import dropping, materialize
from ..plans.star import REPORT_KINDS, Star
from ..schema import CHILD_KINDS, MONEY, MOVIE, REJECTS, SEQ
from .buckets import Buckets

_ENTITY = [T.StructField("kind", T.StringType()), T.StructField("entity_key", T.StringType())]
_FACTS = [T.StructField("budget", MONEY), T.StructField("box_office", MONEY), T.StructField("release_date", T.DateType())]
_WHOLE = T.DecimalType(38, 0)
_BITS = 20
_MASK = 2 ** _BITS - 1

TABLES = {
    "movies": (T.StructType([T.StructField("movie_id", T.LongType()), T.StructField("movie_key", T.StringType()),
                             T.StructField("movie", T.StringType()), T.StructField("first_seq", SEQ), *_FACTS,
                             T.StructField("fact_seq", SEQ)]), ["movie_key"]),
    "dimensions": (T.StructType([*_ENTITY, T.StructField("entity_id", T.LongType()), T.StructField("entity", T.StringType()),
                                 T.StructField("first_seq", SEQ)]), ["kind", "entity_key"]),
    "bridges": (T.StructType([*_ENTITY, T.StructField("movie_key", T.StringType())]), ["movie_key"]),
    "credited": (T.StructType([*_ENTITY, T.StructField("release_year", T.IntegerType()), T.StructField("box_office", MONEY),
                               T.StructField("n", T.LongType())]), ["kind", "entity_key"]),
    "state": (T.StructType([*_ENTITY, T.StructField("release_year", T.IntegerType()), T.StructField("n", T.LongType()),
                            T.StructField("s1", _WHOLE), T.StructField("s2", _WHOLE), T.StructField("most", MONEY),
                            T.StructField("least", MONEY)]), ["kind", "entity_key"]),
}


def open_store(spark: SparkSession, path: str, buckets: int = 32) -> Buckets:
    """The store in `path`; `buckets` counts when it is new."""
    return Buckets(spark, path, TABLES, buckets)


def apply(store: Buckets, film_items: DataFrame, credit_items: DataFrame, source: str, position: int,
          refresh: bool = True) -> bool:
    """Merge items (schema.FILM_ITEMS, schema.CREDIT_ITEMS) into the store.
    False if the source's position was merged before."""
    old = store.manifest()
    if position <= old["positions"].get(source, -1):
        return False
    new = {**old, "version": old["version"] + 1, "positions": {**old["positions"], source: position}, "ids": dict(old["ids"])}
    with dropping(store.spark) as keep:
        films = keep(clean.clean_film_items(film_items).drop("page_id"), "films-clean")
        # keys follow from film and value: making them again costs less than writing and reading them
        credits = keep(clean.clean_credit_items(credit_items).drop("page_id", "movie_key", "entity_key"), "credits-clean")
        credits = credits.withColumns({"movie_key": text.name_key(F.col("film")), "entity_key": text.name_key(F.col("value"))})
        changed, buckets = _merge_movies(store, old, new, films, credits, keep)
        _merge_dimensions(store, old, new, credits, keep)
        _maintain(store, old, new, _merge_bridges(store, old, new, credits, changed, buckets, keep), keep)
        store.append(new, "rejects", REJECTS, clean.rejects(films, credits))
        if refresh:
            new["reports"] = {}
            for name in REPORT_KINDS:
                folder = f"data/reports/{new['version']}-{name}-{os.urandom(4).hex()}"
                report(store, name, new).write.parquet(f"{store.path}/{folder}")
                new["reports"][name] = folder
        store.commit(new)
    return True


def load_new(store: Buckets, film_items: DataFrame, credit_items: DataFrame, source: str = "log", refresh: bool = True) -> bool:
    """Merge the items of a log behind the recorded position, its greatest
    seq so far (L9). False if there are none."""
    done = F.lit(str(store.manifest()["positions"].get(source, -1))).cast(SEQ)
    films, credits = (df.where(F.col("seq") > done) for df in (film_items, credit_items))
    last = films.select("seq").unionByName(credits.select("seq")).agg(F.max("seq")).first()[0]
    return last is not None and apply(store, films, credits, source, int(last), refresh)


def _earlier(side: str, other: str) -> Column:
    return F.col(f"{other}.first_seq").isNull() | (F.col(f"{side}.first_seq") < F.col(f"{other}.first_seq"))


def _merge_movies(store: Buckets, old: dict, new: dict, films: DataFrame, credits: DataFrame, keep) -> tuple[DataFrame, list[int]]:
    """Writes movies. Returns the films of the batch with box office and year
    before and after, and their buckets."""
    fresh = keep(model.film_titles(films, credits).join(model.film_facts(films), "movie_key", "left"), "films-new")
    buckets = store.touched("movies", fresh)
    both = store.read(old, "movies", buckets).alias("o").join(fresh.alias("f"), "movie_key", "full")
    later = F.col("f.fact_seq").isNotNull() & (F.col("o.fact_seq").isNull() | (F.col("f.fact_seq") > F.col("o.fact_seq")))

    def fact(name: str) -> Column:
        return F.when(later, F.col(f"f.{name}")).otherwise(F.col(f"o.{name}")).alias(name)

    first = F.col("f.first_seq").isNotNull() & _earlier("f", "o")
    merged = keep(both.select(
        "o.movie_id", "movie_key", F.when(first, F.col("f.movie")).otherwise(F.col("o.movie")).alias("movie"),
        F.least("o.first_seq", "f.first_seq").alias("first_seq"), *map(fact, ("budget", "box_office", "release_date", "fact_seq")),
        F.col("f.first_seq").isNotNull().alias("in_batch"), F.col("o.box_office").alias("old_box_office"),
        F.year("o.release_date").alias("old_year")), "films-merged")
    rows, before = merged.select(*TABLES["movies"][0].names), old["ids"].get(MOVIE, 0)
    numbered, n = _numbers(rows.where("movie_id is null"), ["first_seq", "movie_key"])
    new["ids"][MOVIE] = before + n
    if n:
        rows = rows.where("movie_id is not null").unionByName(numbered.withColumn("movie_id", F.col("number") + before).drop("number"))
    store.write(new, "movies", rows, buckets)
    changed = merged.where("in_batch").select("movie_key", "box_office", F.year("release_date").alias("year"), "old_box_office", "old_year")
    return changed, buckets


def _numbers(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with a dense number from 1 in `order`, and how many there are."""
    n = rows.count()
    return row_number_global(rows, [F.col(c) for c in order], "number") if n else rows, n


def _merge_dimensions(store: Buckets, old: dict, new: dict, credits: DataFrame, keep) -> None:
    key = ["kind", "entity_key"]
    fresh = keep(model.entity_names(credits), "entities-new")
    buckets = store.touched("dimensions", fresh)
    both = store.read(old, "dimensions", buckets).alias("o").join(fresh.alias("f"), key, "full")
    first = F.col("f.first_seq").isNotNull() & _earlier("f", "o")
    merged = keep(both.select(*key, "o.entity_id", F.when(first, F.col("f.entity")).otherwise(F.col("o.entity")).alias("entity"),
                              F.least("o.first_seq", "f.first_seq").alias("first_seq")), "entities-merged")
    unnumbered = merged.where("entity_id is null")
    counts = {r.kind: r.n for r in unnumbered.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # four kinds
    shift, seen = F.lit(0), 0
    for kind in sorted(counts):
        shift = F.when(F.col("kind") == kind, old["ids"].get(kind, 0) - seen).otherwise(shift)
        seen += counts[kind]
    new["ids"].update({k: old["ids"].get(k, 0) + counts.get(k, 0) for k in CHILD_KINDS})
    if counts:
        numbered, _ = _numbers(unnumbered, ["kind", "first_seq", "entity_key"])
        merged = merged.where("entity_id is not null").unionByName(numbered.withColumn("entity_id", F.col("number") + shift).drop("number"))
    store.write(new, "dimensions", merged, buckets)


def _merge_bridges(store: Buckets, old: dict, new: dict, credits: DataFrame, changed: DataFrame, buckets: list[int], keep) -> DataFrame:
    """Writes bridges. `buckets` are those of the films `changed`. Returns the
    pairs whose film's value changes for their entity: kind, entity_key,
    held (not a new pair), of new pairs movie_key, box_office and year,
    old_box_office and old_year.

    Held and credited pairs meet in one hash aggregation that says which are
    held; it and the joins with the films share one exchange by film. The joins
    look pairs up among their partition's films, so no pair is sorted; held
    pairs of films outside the batch go before the aggregation. The films' hash
    stands before the key: numbers are compared before texts."""
    pair, film = ["kind", "entity_key", "movie_key"], [F.xxhash64("movie_key").alias("h"), F.col("movie_key")]
    moved = ~(F.col("box_office").eqNullSafe(F.col("old_box_office")) & F.col("year").eqNullSafe(F.col("old_year")))
    films = keep(changed.withColumn("moved", moved), "films-changed")
    credited = model.credited_pairs(credits)
    # a credit without a seq makes no film: its film may be none of the changed
    unseen = store.touched("bridges", model.credited_pairs(credits.where("seq is null")))
    tagged = (store.read(old, "bridges", {*buckets, *unseen}).select(*pair, F.lit(True).alias("held"))
              .unionByName(credited.select(*pair, F.lit(False).alias("held"))))
    tagged = tagged.select(*film, "kind", "entity_key", "held").repartition("h", "movie_key")
    if store.holds(old, "bridges", buckets):
        in_batch = films.select(*film, F.lit(True).alias("in_batch")).hint("shuffle_hash")
        tagged = tagged.join(in_batch, ["h", "movie_key"], "left").where("in_batch or not held")
    met = tagged.groupBy("h", "movie_key", "kind", "entity_key").agg(F.max("held").alias("held"))
    facts = films.select(*film, "box_office", "year", "old_box_office", "old_year", "moved").hint("shuffle_hash")
    # left: a new pair is kept whose film has no row yet (its credit had no seq)
    pairs = met.join(facts, ["h", "movie_key"], "left").where("moved or not held").drop("h", "moved")
    pairs = keep(pairs.withColumn("movie_key", F.expr("if(held, null, movie_key)")), "pairs-changed")
    added = pairs.where("not held").select(*pair)
    buckets = store.touched("bridges", added)
    if buckets:
        store.write(new, "bridges", store.read(old, "bridges", buckets).unionByName(added), buckets,
                    dealt=not store.holds(old, "bridges", buckets))
    return pairs


def _whole_sums(box_office: Column, sign: Column) -> list[Column]:
    """Partial sums of the box office in millionths and of its square, as whole
    numbers of 64 bits: decimals of that width cost a multiple. Box offices have
    12 digits, so a piece has at most 23 bits and its sum holds 10**12 rows."""
    m = F.rint(box_office.cast("double") * 1e6).cast("bigint")  # exact: 12 digits fit a double
    high, low = F.shiftright(m, _BITS), m.bitwiseAND(_MASK)
    cross = high * low * 2
    upper, lower = high * high + F.shiftright(cross, _BITS), cross.bitwiseAND(_MASK) * (_MASK + 1) + low * low
    pieces = {"s1_1": high, "s1_0": low, "s2_3": F.shiftright(upper, _BITS), "s2_2": upper.bitwiseAND(_MASK),
              "s2_1": F.shiftright(lower, _BITS), "s2_0": lower.bitwiseAND(_MASK)}
    return [F.sum(piece * sign).alias(name) for name, piece in pieces.items()]


def _joined_sums(name: str, pieces: int) -> Column:
    """s1 or s2 from its pieces."""
    parts = [(F.col(f"{name}_{k}").cast("decimal(19,0)") * F.lit(Decimal(2 ** (_BITS * k)))).cast(_WHOLE) for k in range(pieces)]
    return reduce(lambda a, b: (a + b).cast(_WHOLE), parts).alias(name)


def _maintain(store: Buckets, old: dict, new: dict, pairs: DataFrame, keep) -> None:
    """Writes credited and state."""
    # a null year is a year of its own: groups are keyed by it with -1 in its place
    entity, group = ["kind", "entity_key"], ["kind", "entity_key", "year"]

    def keyed(year: str) -> Column:
        return F.coalesce(year, F.lit(-1)).alias("year")

    lost = pairs.where("held and old_box_office is not null").select(
        *entity, keyed("old_year"), F.col("old_box_office").alias("box_office"), F.lit(-1).cast("bigint").alias("sign"))
    gained = pairs.where("box_office is not null").select(*entity, keyed("year"), "box_office", F.lit(1).cast("bigint").alias("sign"))
    changes = lost.unionByName(gained)
    gone, come = F.when(F.col("sign") < 0, F.col("box_office")), F.when(F.col("sign") > 0, F.col("box_office"))
    delta = keep(changes.groupBy(*group).agg(
        F.sum("sign").alias("n"), *_whole_sums(F.col("box_office"), F.col("sign")), F.max(come).alias("most"), F.min(come).alias("least"),
        F.max(gone).alias("gone_most"), F.min(gone).alias("gone_least")), "state-changes")
    buckets = store.touched("state", delta)
    if not buckets:
        return
    # a row of a store that counted no values yet stands for one film
    held = store.read(old, "credited", buckets).select(*entity, keyed("release_year"), "box_office", F.coalesce("n", F.lit(1)).alias("sign"))
    values = held.unionByName(changes).groupBy(*group, "box_office").agg(F.sum("sign").alias("n")).where("n > 0")
    year = F.when(F.col("year") >= 0, F.col("year")).cast("int").alias("release_year")
    store.write(new, "credited", values.select(*entity, year, "box_office", "n"), buckets, dealt=True)

    delta = delta.withColumns({"s1": _joined_sums("s1", 2), "s2": _joined_sums("s2", 4)})
    none = F.lit(None).cast(MONEY)
    held = store.read(old, "state", buckets).select(*entity, keyed("release_year"), "n", "s1", "s2", "most", "least",
                                                    none.alias("gone_most"), none.alias("gone_least"))
    is_held = F.lit(True).alias("held")
    summed = held.select("*", is_held).unionByName(delta.select(*held.columns, F.lit(False).alias("held"))).groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in ("n", "s1", "s2")], F.max("most").alias("most"), F.min("least").alias("least"),
        F.max(F.when(F.col("held"), F.col("most"))).alias("was_most"), F.min(F.when(F.col("held"), F.col("least"))).alias("was_least"),
        F.max("gone_most").alias("gone_most"), F.min("gone_least").alias("gone_least"))
    # a retracted value reached the maximum or minimum there was: the group's values are looked at again
    lowered = F.coalesce((F.col("gone_most") >= F.col("was_most")) | (F.col("gone_least") <= F.col("was_least")), F.lit(False))
    summed = keep(summed.where("n > 0").withColumn("lowered", lowered), "state-merged")
    again = store.touched("state", summed.where("lowered"))
    extremes = (store.read(new, "credited", again).groupBy(*entity, keyed("release_year"))
                .agg(F.max("box_office").alias("true_most"), F.min("box_office").alias("true_least")))
    state = summed.join(extremes, group, "left").select(
        *entity, year, "n", "s1", "s2",
        F.when(F.col("lowered"), F.col("true_most")).otherwise(F.col("most")).alias("most"),
        F.when(F.col("lowered"), F.col("true_least")).otherwise(F.col("least")).alias("least"))
    store.write(new, "state", state, buckets)


# ---- reading

def read_star(store: Buckets) -> Star:
    """The stored tables as a Star, with dense ids."""
    m = store.manifest()
    movies, dims = store.read(m, "movies"), store.read(m, "dimensions")
    bridges = (store.read(m, "bridges").join(movies.select("movie_key", "movie_id"), "movie_key")
               .join(dims.select("kind", "entity_key", "entity_id"), ["kind", "entity_key"]))
    return Star(movies.select("movie_id", "movie_key", "movie", "budget", "box_office", "release_date"),
                dims.select("kind", "entity_id", "entity_key", "entity"),
                bridges.select("kind", "movie_id", "entity_id", "movie_key", "entity_key"),
                store.read_log(m, "rejects", REJECTS))


def report(store: Buckets, name: str, manifest: dict | None = None) -> DataFrame:
    """One of plans.star.REPORTS from the kept state."""
    manifest = manifest or store.manifest()
    kind, entity_col, all_label = REPORT_KINDS[name]
    state = store.read(manifest, "state").where(F.col("kind") == kind)
    names = store.read(manifest, "dimensions").where(F.col("kind") == kind).select("entity_key", F.col("entity").alias(entity_col))
    return reports.from_state(state, names, entity_col, all_label)


def read_report(store: Buckets, name: str) -> DataFrame:
    """A report as the last change refreshed it."""
    return store.spark.read.parquet(f"{store.path}/{store.manifest()['reports'][name]}")
