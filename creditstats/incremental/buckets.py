"""Keyed tables in buckets, switched by a manifest.

A table's rows lie in a fixed number of buckets by the hash of its key. A
change writes new files of the buckets it touches into folders of its own
version and then a manifest that names, for every bucket of every table, the
folder that holds it. Readers take the newest manifest, so

* a read costs one folder a bucket, however many changes there were;
* all tables switch together: the manifest appears by a rename;
* after a crash before the rename the old manifest stands, and the change is
  made again; what it had written is never read.

There is one writer at a time (a load, or a streaming query with its
checkpoint). `vacuum` deletes what the last manifests do not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIRST = {"version": 0, "positions": {}, "ids": {}, "tables": {}, "logs": {}, "reports": {}}
LOG_RUN = 8  # log folders of one level that are rewritten as one of the next


class Buckets:
    """The store in the folder `path`. `tables`: name -> (schema, key columns)."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, tuple[StructType, list[str]]], buckets: int = 32):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.buckets = self.manifest().get("buckets", buckets)

    # -- files

    def _children(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def _read(self, file: str) -> str:
        stream = self.fs.open(self._path(file))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._children(f"{self.path}/manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        versions = self._versions() if version is None else [version]
        return json.loads(self._read(f"{self.path}/manifests/{versions[-1]:012d}.json")) if versions else dict(FIRST)

    def commit(self, manifest: dict) -> None:
        """Make `manifest` the current one."""
        folder = f"{self.path}/manifests"
        to, draft = self._path(f"{folder}/{manifest['version']:012d}.json"), self._path(f"{folder}/.draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft)
        out.write(bytearray(json.dumps({**manifest, "buckets": self.buckets}).encode()))
        out.close()
        if self.fs.exists(to) or not self.fs.rename(draft, to):
            raise RuntimeError(f"version {manifest['version']} was written by another writer")

    # -- tables

    def bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[table][1]), F.lit(self.buckets)).cast("int")

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys: at most `buckets` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket(table)).distinct().collect())

    def read(self, manifest: dict, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        schema, held = self.tables[table][0], manifest["tables"].get(table, {})
        wanted = held if buckets is None else {str(b) for b in buckets} & held.keys()
        paths = [f"{self.path}/{held[b]}/bucket={b}" for b in sorted(wanted, key=int)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self._empty(schema)

    def _empty(self, schema: StructType) -> DataFrame:
        """No rows, which the optimizer knows: joins and unions with them go."""
        return self.spark.createDataFrame([], schema).where(F.lit(False))

    def holds(self, manifest: dict, table: str, buckets: Iterable[int]) -> bool:
        """Whether the table has any of the buckets."""
        return bool({str(b) for b in buckets} & manifest["tables"].get(table, {}).keys())

    def write(self, manifest: dict, table: str, rows: DataFrame, buckets: Iterable[int], dealt: bool = False) -> None:
        """Replace `buckets` of the table by `rows` in a manifest not yet
        committed. Spark cuts a large bucket into several files. Rows that are
        `dealt` lie in partitions of a good size already; they are not moved
        again, and a bucket gets a file from each of these."""
        folder = f"data/{table}/{manifest['version']}-{uuid.uuid4().hex[:8]}"
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.tables[table][0]], self.bucket(table).alias("bucket"))
        (rows if dealt else rows.hint("rebalance", "bucket")).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        made = {n[7:] for n in self._children(f"{self.path}/{folder}") if n.startswith("bucket=")}
        held = {b: f for b, f in manifest["tables"].get(table, {}).items() if int(b) not in set(buckets)}
        manifest["tables"] = {**manifest["tables"], table: {**held, **{b: folder for b in made}}}

    # -- logs: rows only added

    def append(self, manifest: dict, log: str, schema: StructType, rows: DataFrame) -> None:
        """Add rows. LOG_RUN folders of one level become one of the next, so
        the folders to read grow with the logarithm of the changes."""
        entries = [*manifest["logs"].get(log, []), [0, self._log_folder(log, manifest, rows)]]
        level = 0
        while sum(e[0] == level for e in entries) >= LOG_RUN:
            run = [f"{self.path}/{f}" for at, f in entries if at == level]
            folder = self._log_folder(log, manifest, self.spark.read.schema(schema).parquet(*run).hint("rebalance"))
            entries = [e for e in entries if e[0] != level] + [[level + 1, folder]]
            level += 1
        manifest["logs"] = {**manifest["logs"], log: entries}

    def _log_folder(self, log: str, manifest: dict, rows: DataFrame) -> str:
        folder = f"data/{log}/{manifest['version']}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def read_log(self, manifest: dict, log: str, schema: StructType) -> DataFrame:
        paths = [f"{self.path}/{f}" for _, f in manifest["logs"].get(log, [])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self._empty(schema)

    # -- cleaning up

    def vacuum(self, keep: int = 2) -> None:
        """Delete the data folders that the last `keep` manifests do not name,
        and older manifests. Frames read from those fail from then on."""
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {f for m in kept for held in m["tables"].values() for f in held.values()}
        named |= {f for m in kept for entries in m["logs"].values() for _, f in entries} | {f for m in kept for f in m["reports"].values()}
        for table in self._children(f"{self.path}/data"):
            for folder in self._children(f"{self.path}/data/{table}"):
                if f"data/{table}/{folder}" not in named:
                    self.fs.delete(self._path(f"{self.path}/data/{table}/{folder}"), True)
        for v in versions[:-keep]:
            self.fs.delete(self._path(f"{self.path}/manifests/{v:012d}.json"), False)
