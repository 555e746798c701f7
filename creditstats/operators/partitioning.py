"""Tables written once and read by several consumers."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def _root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"tables-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a parquet table in the shared folder and return a
    DataFrame that reads it.

    Used where one expensive result feeds several consumers: Spark would
    otherwise recompute it for each (column pruning makes the consumers'
    subtrees differ, so no exchange is reused). It also cuts the lineage: a
    lost executor recomputes from the written table. `drop_materialized`
    removes the tables of the application."""
    spark = df.sparkSession
    path = os.path.join(_root(spark), f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Remove what `materialize` wrote in this application; frames that
    still read it fail from then on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def dropping(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """`materialize` whose tables are removed when the block ends."""
    folder = f"step-{uuid.uuid4().hex}"
    try:
        yield lambda df, name: materialize(df, f"{folder}/{name}")
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(_root(spark), folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
