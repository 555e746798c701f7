"""Distributed total ordering with a dense row number.

A window without partitionBy moves every row into one task. Instead:

1. range-partition on the sort keys (Spark samples the keys for bounds),
   sort within each partition, and let monotonically_increasing_id() encode
   (partition id, position in partition) natively;
2. write that once to the shared folder. Range bounds are sampled anew each
   time a plan is run, so positions and counts must come from one run;
3. the per-partition row counts form a table with one row per partition,
   whose running sum gives each partition's offset. That table's size is
   bounded by the partition count, so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .partitioning import materialize

_POS_BITS = 33  # monotonically_increasing_id layout: partition id << 33 | position


def row_number_global(df: DataFrame, order: list[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = materialize(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))),
        "ordered",
    )
    counts = ids.groupBy("_pid").agg(F.count("*").alias("_n"))
    # One row per partition: a window over it is tiny by construction.
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    return (
        ids.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + F.lit(1))
        .drop("_mid", "_pid", "_pos", "_off")
    )
