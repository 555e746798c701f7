"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship

# Word separators of all word counts here: space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and gives the planner exact sizes."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the operators staged; results not yet written are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(ensure_checkpoint_dir(spark), "llm"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """`base`, lengthened until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_locator(df: DataFrame, name: str = "_locator") -> DataFrame:
    """Add a struct (file, row) that names each row of a file-backed frame.

    Two equal rows still differ in it, and a recomputed task gives the same
    value. A frame that is no plain file scan is staged first."""
    def located(x: DataFrame) -> DataFrame:
        return x.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.row_index").alias("row")))

    if "_metadata" not in df.columns:
        try:
            return located(df)
        except AnalysisException:
            pass  # not a file scan: staged below
    hidden = free_name(df, "_metadata_column")
    return located(staged(df.withColumnRenamed("_metadata", hidden), "located")).withColumnRenamed(hidden, "_metadata")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@contextlib.contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]):
    """Set session settings for the time of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# What a Python worker keeps from task to task: one operator's state, so that
# the next operator's tasks free it.
_KEPT: dict = {}


def _free_memory() -> None:
    """Give freed memory back to the system where the C library can: what one
    operator's tasks held does not add to the next one's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def worker_state(owner: str, make):
    """The state kept for `owner` in this worker, made when another owner's
    was kept or none."""
    if owner not in _KEPT:
        _KEPT.clear()
        _free_memory()
        _KEPT[owner] = make()
    return _KEPT[owner]


# Rows of an Arrow batch, where the session has Spark's default: texts are long.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000")}


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """`df.mapInArrow` with this package sent to the workers as a job file
    and batches bounded."""
    spark = df.sparkSession
    ship(spark)
    for key, (default, rows) in BATCH_ROWS.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, rows)
    return df.mapInArrow(function, schema)
