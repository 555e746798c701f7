"""Star-schema modelling (L1-L9, L12): cleaned items -> films, dimensions,
bridges.

The reference loads item by item with get-or-create lookups under a
case-, accent- and trailing-space-insensitive collation. As set
operations over the whole item log:

  films       first spelling by seq among all items, and the latest accepted
              film item's facts (a null amount overwrites, L6) (L2, L6, L7)
  dimensions  first spelling per (kind, entity_key) (L3)
  bridges     distinct (kind, movie_key, entity_key), with ids (L5)

Spellings are found in two steps: the smallest seq per spelling (a hash
aggregation of fixed-width state, combined on the map side; a key follows from
its spelling, so it is made after this step, once a spelling), then the
spelling that has the smallest seq per key, over distinct spellings only. seq
is unique, so one spelling has it.

Replaying the log gives the same tables (L9): minima, max_by over a total
order and distinct are idempotent under duplication. Surrogate ids here are
xxhash64 of the key (L4), found without a look at other rows; the stored star
(`incremental.star_store`) numbers its keys densely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .clean import FILM_ROW_KEPT


def _first(spelled: DataFrame, keys: list[str]) -> DataFrame:
    """Of distinct spellings with a seq, those with the least one per key, as
    first_seq. One exchange; the rows it sorts are spellings, not items."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy("seq"))
    return spelled.where("seq is not null").withColumn("_rank", rank).where("_rank = 1").drop("_rank").withColumnRenamed("seq", "first_seq")


def film_titles(films_clean: DataFrame, credits_clean: DataFrame) -> DataFrame:
    """Films whose row the loader creates or finds: movie_key, movie (first
    spelling), first_seq."""
    r = F.col("reason")
    # A filter on `reason` would be pushed through the cleaning stages and
    # repeat every rule in it: null sequence numbers drop the rows instead.
    seq = F.when(r.isNull() | r.isin(*FILM_ROW_KEPT), F.col("seq")).alias("seq")
    named = films_clean.select("film", seq).unionByName(credits_clean.select("film", seq))
    spelled = named.groupBy("film").agg(F.min("seq").alias("seq")).select(text.name_key(F.col("film")).alias("movie_key"), "film", "seq")
    return _first(spelled, ["movie_key"]).select("movie_key", F.col("film").alias("movie"), "first_seq")


def film_facts(films_clean: DataFrame) -> DataFrame:
    """Per film key of a film item: the latest accepted one's budget,
    box_office, release_date and its seq (fact_seq); null if none was
    accepted. One hash aggregation: every value and the seq are of fixed width."""
    seq = F.when(F.col("reason").isNull(), F.col("seq"))
    return films_clean.groupBy("movie_key").agg(
        *[F.max_by(c, seq).alias(c) for c in ("budget", "box_office", "release_date")], F.max(seq).alias("fact_seq"))


def build_movies(films_clean: DataFrame, credits_clean: DataFrame) -> DataFrame:
    """One row per film key: movie_id, movie_key, movie (first spelling),
    budget, box_office, release_date (latest accepted film item, or nulls
    for a stub film that only credits created)."""
    return film_titles(films_clean, credits_clean).join(film_facts(films_clean), "movie_key", "left").select(
        F.xxhash64("movie_key").alias("movie_id"), "movie_key", "movie", "budget", "box_office", "release_date")


def build_facts(films_clean: DataFrame) -> DataFrame:
    """Films with their latest accepted facts, from film items alone:
    movie_key, movie (the key), budget, box_office, release_date. Every film
    with a known box office has an accepted film item, so for the reports
    (which keep only those films and count them) this equals `build_movies`
    without reading the credit items; titles are left to build_movies."""
    return film_facts(films_clean).select("movie_key", F.col("movie_key").alias("movie"), "budget", "box_office", "release_date")


def _accepted(credits_clean: DataFrame) -> DataFrame:
    return credits_clean.where(F.col("reason").isNull())


def build_spellings(credits_clean: DataFrame) -> DataFrame:
    """Credited pairs by spelling: kind, movie_key, entity_key, value, and
    the smallest seq. They are dealt by film once, for this aggregation, that
    of the pairs and the join with the films. An accepted credit has both keys:
    the filter says so, as a join on one would say it in its own branch only,
    which then could not share the exchange."""
    kept = _accepted(credits_clean).where("movie_key is not null and entity_key is not null")
    return (kept.select("kind", "movie_key", "entity_key", "value", "seq").repartition("movie_key")
            .groupBy("kind", "movie_key", "entity_key", "value").agg(F.min("seq").alias("seq")))


def entity_names(credits_clean: DataFrame) -> DataFrame:
    """kind, entity_key, entity (first spelling), first_seq."""
    spelled = (_accepted(credits_clean).groupBy("kind", "value").agg(F.min("seq").alias("seq"))
               .select("kind", text.name_key(F.col("value")).alias("entity_key"), "value", "seq"))
    return _first(spelled, ["kind", "entity_key"]).select("kind", "entity_key", F.col("value").alias("entity"), "first_seq")


def build_dimensions(credits_clean: DataFrame) -> DataFrame:
    """All four entity dimensions: kind, entity_id, entity_key, entity
    (first spelling)."""
    return entity_names(credits_clean).select("kind", F.xxhash64("kind", "entity_key").alias("entity_id"), "entity_key", "entity")


def credited_pairs(credits_clean: DataFrame) -> DataFrame:
    """The pair of every accepted credit: kind, entity_key, movie_key."""
    return _accepted(credits_clean).select("kind", "entity_key", "movie_key")


def accepted_pairs(credits_clean: DataFrame) -> DataFrame:
    """Distinct credited pairs: kind, entity_key, movie_key."""
    return credited_pairs(credits_clean).distinct()


def with_ids(pairs: DataFrame) -> DataFrame:
    return pairs.select("kind", F.xxhash64("movie_key").alias("movie_id"),
                        F.xxhash64("kind", "entity_key").alias("entity_id"), "movie_key", "entity_key")


def build_bridges(credits_clean: DataFrame) -> DataFrame:
    """All four bridges: distinct (kind, movie_key, entity_key), with their ids."""
    return with_ids(accepted_pairs(credits_clean))


def dimension(dims: DataFrame, kind: str) -> DataFrame:
    return dims.where(F.col("kind") == kind).drop("kind")


def bridge(bridges: DataFrame, kind: str) -> DataFrame:
    return bridges.where(F.col("kind") == kind).drop("kind")


# --- data-quality checks (L12) ---------------------------------------------

def dq_duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once (a UNIQUE violation)."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def dq_id_collisions(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Surrogate ids shared by different keys."""
    return (df.groupBy(id_col).agg(F.countDistinct(key_col).alias("n_keys"))
            .where(F.col("n_keys") > 1))


def dq_orphans(child: DataFrame, parent: DataFrame, on: list[str] | str) -> DataFrame:
    """Child rows whose parent key is missing (a FOREIGN KEY violation)."""
    return child.join(parent.select(on if isinstance(on, list) else [on]).distinct(), on, "left_anti")


# --- generic ordered pick (L6) -------------------------------------------

def latest_by(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Last write wins: per key, the values of the row with the greatest
    `order` (compared column by column, nulls least), nulls among them kept.
    `order` names a row within its key; equal rows count as one.

    Each order column's maximum is a hash aggregation of fixed-width state,
    combined on the map side (a hot key is reduced before the shuffle); a
    semi-join then leaves the rows that have it. No row is sorted to find it."""
    picked = df.select(*keys, *order, *[v for v in values if v not in order])
    for c in order:
        most = picked.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(c).alias("_most"))
        same = [picked[k].eqNullSafe(most[f"_{k}"]) for k in keys] + [picked[c].eqNullSafe(most["_most"])]
        picked = picked.join(most, same, "left_semi")
    return picked.distinct().select(*keys, *values)
