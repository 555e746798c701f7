"""The item flow on Structured Streaming (T1-T4): one query, one pass.

  T1  film and credit items are one stream of tagged items; each micro-batch
      is written once to the shared folder and cleaned from there by the same
      column functions as in batch, so the source is scanned once a batch
  T2  films, T3 dimensions and bridges: the batch is merged into the stored
      star (`incremental.star_store`), which reads and writes only the
      buckets of the batch's keys
  T4  the four reports are refreshed with each batch, from state that takes
      the batch's retractions and additions

All of a batch's changes appear together by one manifest, which records the
batch's number: a retried batch that was committed is skipped, one that was
not is made again. The source has no event time, so a key's rows are kept,
like the reference's tables (no watermark).

Checkpoints go under the session's checkpoint folder (the shared folder a
cluster names in spark.checkpoint.dir) unless a location is given.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..incremental import star_store
from ..operators.partitioning import dropping
from ..plans.star import REPORT_KINDS, Star
from ..schema import CREDIT_ITEMS, FILM_ITEMS, MOVIE
from ..session import ensure_checkpoint_dir

SOURCE = "stream"


def items(film_stream: DataFrame, credit_stream: DataFrame) -> DataFrame:
    """Film and credit items as one stream: all columns of both, and kind."""
    films = film_stream.select(*FILM_ITEMS.names, F.lit(MOVIE).alias("kind"))
    return films.unionByName(credit_stream.select(*CREDIT_ITEMS.names), allowMissingColumns=True)


def merge(out_dir: str, buckets: int = 32, refresh: bool = True):
    """A foreachBatch function that merges tagged items into the store."""
    def step(batch: DataFrame, batch_id: int) -> None:
        store = star_store.open_store(batch.sparkSession, out_dir, buckets)
        with dropping(batch.sparkSession) as keep:
            tagged = keep(batch, "items")
            # few files hold all films, whose cleaning is dear: they are dealt to all cores
            films = tagged.where(F.col("kind") == MOVIE).select(*FILM_ITEMS.names).repartition(batch.sparkSession.sparkContext.defaultParallelism)
            star_store.apply(store, films, tagged.where(F.col("kind") != MOVIE).select(*CREDIT_ITEMS.names), SOURCE, batch_id, refresh)
    return step


def start(film_stream: DataFrame, credit_stream: DataFrame, out_dir: str, checkpoint_root: str | None = None,
          available_now: bool = True, processing_time: str | None = None, buckets: int = 32, refresh: bool = True) -> StreamingQuery:
    """Start the query that keeps the star and the reports in `out_dir`."""
    root = checkpoint_root or os.path.join(ensure_checkpoint_dir(film_stream.sparkSession), "creditstats-streams")
    writer = (items(film_stream, credit_stream).writeStream.foreachBatch(merge(out_dir, buckets, refresh))
              .option("checkpointLocation", os.path.join(root, "items")).queryName("creditstats_items"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start()


def read_star(spark: SparkSession, out_dir: str) -> Star:
    """The tables as of the last batch; empty ones before the first."""
    return star_store.read_star(star_store.open_store(spark, out_dir))


def read_reports(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The four reports as the last batch refreshed them."""
    store = star_store.open_store(spark, out_dir)
    return {name: star_store.read_report(store, name) for name in REPORT_KINDS}
