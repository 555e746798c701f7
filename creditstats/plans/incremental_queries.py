"""Registered queries for loads in parts and the stream (L4, L9, T1-T4),
over whole driver tables, with their DuckDB oracles."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..incremental import star_store
from ..incremental.buckets import Buckets
from ..operators.partitioning import materialize
from ..schema import CREDIT_ITEMS, FILM_ITEMS
from ..session import ensure_checkpoint_dir
from ..streaming import star_stream
from . import oracle_sql
from .driver_items import driver_items

BUCKETS = 8
STREAM_BATCHES = 2
ITEMS_PER_FILE = 2_000_000  # the most on average; a task writes one file


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _loaded_in_parts(spark: SparkSession, sf_dir: str) -> Buckets:
    """All items of the driver tables, loaded as a log in two steps: first
    the older half of the orders' items, then the whole log again, of which
    only the rest is behind the recorded position. Before both, every film
    came with other facts, which the later items replace. The log is written
    once; each load reads what it needs of it."""
    films, credits = driver_items(spark, sf_dir)
    films = materialize(films.repartition(spark.sparkContext.defaultParallelism), "log-films")
    credits = materialize(credits, "log-credits")
    store = star_store.open_store(spark, _folder(spark, "loaded-in-parts"), BUCKETS)
    before = (F.col("seq") - F.lit(str(10 ** 30)).cast("decimal(38,0)")).cast("decimal(38,0)")
    early = films.withColumns({"seq": before, "box_office": F.lit("$999,999 million"), "release_date": F.lit("1950")})
    star_store.apply(store, early, credits.withColumn("seq", before), "older log", 0, refresh=False)
    middle = films.agg(F.percentile_approx("seq", 0.5)).first()[0]
    star_store.load_new(store, films.where(F.col("seq") <= middle), credits.where(F.col("seq") <= middle), refresh=False)
    star_store.load_new(store, films, credits)
    return store


def _listed(report: DataFrame, name: str, entity_col: str) -> DataFrame:
    year = F.col("release_year") if "release_year" in report.columns else F.lit(None).cast("string")
    return report.select(F.lit(name).alias("report"), F.col(entity_col).alias("entity"), year.alias("release_year"), *STATS)


def load_in_parts_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actors' report and the distributors' rollup, kept
    through the loads."""
    store = _loaded_in_parts(spark, sf_dir)
    return _listed(star_store.read_report(store, "by_actor"), "actor", "actor").unionByName(
        _listed(star_store.read_report(store, "by_distributor"), "distributor", "distributor"))


def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: ids of films in order of arrival, from 1 without gaps, unchanged by
    later loads."""
    store = _loaded_in_parts(spark, sf_dir)
    return store.read(store.manifest(), "movies").select("movie_id", "movie", "box_office", "release_date")


def _streamed(items: DataFrame, schema: StructType, path: str) -> DataFrame:
    """The items as a stream of files in STREAM_BATCHES micro-batches. The
    files of a batch grow in number with the items, not in size."""
    files = max(1, math.ceil(items.count() / STREAM_BATCHES / ITEMS_PER_FILE))
    items.repartition(STREAM_BATCHES * files).write.parquet(path)
    return items.sparkSession.readStream.option("maxFilesPerTrigger", files).schema(schema).parquet(path)


def stream_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items as files, streamed in several micro-batches; the
    directors' report and the production companies' rollup after the last."""
    films, credits = driver_items(spark, sf_dir)
    root = _folder(spark, "streamed")
    query = star_stream.start(_streamed(films, FILM_ITEMS, f"{root}/films"), _streamed(credits, CREDIT_ITEMS, f"{root}/credits"),
                              f"{root}/star", f"{root}/checkpoint", buckets=BUCKETS)
    query.awaitTermination()
    found = star_stream.read_reports(spark, f"{root}/star")
    return _listed(found["by_director"], "director", "director").unionByName(
        _listed(found["by_production_company"], "production company", "prod_co"))


STATS = ["box_office_max", "box_office_min", "box_office_avg", "box_office_std", "film_count"]

REGISTRY = {f.__name__: f for f in (load_in_parts_reports, dense_ids, stream_reports)}


def oracles() -> dict[str, str]:
    known = oracle_sql.oracles()

    def both(*parts: tuple[str, str, str]) -> str:
        return " UNION ALL ".join(
            f"SELECT '{name}' AS report, {col} AS entity, {'release_year' if 'rollup' in key else 'CAST(NULL AS VARCHAR)'} AS release_year, "
            f"{', '.join(STATS)} FROM ({known[key]}) t" for name, col, key in parts)

    return {
        "load_in_parts_reports": both(("actor", "actor", "film_actor_report"), ("distributor", "distributor", "film_distributor_rollup")),
        # the older log holds all films, so their ids are in order of their items
        "dense_ids": """
SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS movie_id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS movie,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,6)) END AS box_office,
       CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) = 4 THEN CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS release_date
FROM orders""",
        "stream_reports": both(("director", "director", "film_director_report"), ("production company", "prod_co", "film_prodco_rollup")),
    }
