"""Session helpers.

Library code never creates or reconfigures a session it was handed; these
helpers are for the bench, tests and command-line entry points.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark configuration.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only below a size bound; above it Spark falls back to a
    # sort-merge join. AQE re-checks with the real shuffle sizes at runtime.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "creditstats", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only a local session without that setting gets a folder of its own; a
    cluster without one is an error, since executors could not see it."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="creditstats-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def ship(spark: SparkSession) -> None:
    """Add this package to the job's Python files, once a context, so that
    workers can import it without an installation."""
    sc = spark.sparkContext
    if getattr(sc, "_creditstats_shipped", False):
        return
    package = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="creditstats-package-"), f"{package.name}.zip")
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(to)
    sc._creditstats_shipped = True
