"""CSV report sink (K1, K2) and table sink (K3).

The reference writes one UTF-8 CSV per report with the `excel` dialect:
comma separator, minimal quoting with doubled quotes, CRLF line ends,
null as an empty field. `write_report_csv` writes sorted part files, each with
the header: their names ascend with the sort order. `write_one_csv` makes one
file of them:

1. the sorted parts are rendered in parallel, without header;
2. the running sum of their sizes gives each part's byte offset;
3. on a file system of shared mounts, tasks copy the parts to their offsets in
   parallel, through a buffer of fixed size; on one that joins files by
   itself (HDFS), the parts are joined there. No task and no driver holds a
   report. The file appears by a rename, when it is whole.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The reference's report headers, in column order.
_STATS = ["box office max (in millions)", "box office min (in millions)",
          "box office avg (in millions)", "box office std (in millions)", "film count"]
_ROLLUP = ["release year", "box office max (in millions)", "box office min (in millions)", "film count",
           "box office avg (in millions)", "box office std (in millions)"]
ENTITY_HEADERS = {
    "actor": ["actor"] + _STATS,
    "director": ["director"] + _STATS,
}
ROLLUP_HEADERS = {
    "distributor": ["distributor"] + _ROLLUP,
    "prod_co": ["production company"] + _ROLLUP,
}
# ---------------------------------------------------------------------------

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\r\n",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def with_headers(df: DataFrame, headers: list[str]) -> DataFrame:
    return df.toDF(*headers)


def write_report_csv(df: DataFrame, path: str, headers: list[str] | None = None,
                     sort_cols: list | None = None) -> None:
    """Write one report as sorted CSV part files under `path`."""
    out = df
    if sort_cols:
        out = out.orderBy(*sort_cols)
    if headers:
        out = with_headers(out, headers)
    writer = out.write.mode("overwrite")
    for k, v in CSV_OPTIONS.items():
        writer = writer.option(k, v)
    writer.csv(path)


BUFFER = 1 << 20


def header_bytes(headers: list[str]) -> bytes:
    out = io.StringIO(newline="")
    csv.writer(out, dialect="excel").writerow(headers)
    return out.getvalue().encode("utf-8")


def csv_lines(df: DataFrame) -> DataFrame:
    """Each row as a line of the excel dialect. (Spark's CSV writer turns a
    line end inside a value into the record separator; this keeps it.)"""
    def field(name: str) -> Column:
        value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(value.rlike('[",\r\n]'), quoted).otherwise(value)

    return df.select(F.concat_ws(",", *map(field, df.columns)).alias("value"))


def _copy(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """(source, offset) rows: writes each source at its offset of `target`.
    A repeated task writes the same bytes at the same place."""
    for batch in batches:
        for source, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with open(source, "rb") as part, open(target, "r+b") as out:
                out.seek(offset)
                while block := part.read(BUFFER):
                    out.write(block)
        yield pa.RecordBatch.from_arrays([batch.column(1)], ["offset"])


def write_one_csv(df: DataFrame, path: str, headers: list[str], sort_cols: list) -> None:
    """Write one report as one sorted CSV file."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    draft, folder = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("draft", "parts"))
    csv_lines(df.orderBy(*sort_cols)).write.option("lineSep", "\r\n").text(folder)
    try:
        parts = sorted((s.getPath().toString(), s.getLen()) for s in fs.listStatus(hadoop(folder))
                       if s.getPath().getName().startswith("part-") and s.getLen())
        head = header_bytes(headers)
        out = fs.create(hadoop(draft))
        out.write(bytearray(head))
        out.close()
        if fs.getScheme() == "file":
            offset, rows = len(head), []
            for source, size in parts:
                rows.append((unquote(urlparse(source).path), offset))
                offset += size
            target = unquote(urlparse(fs.makeQualified(hadoop(draft)).toString()).path)
            if rows:
                spark.createDataFrame(rows, "source string, offset long").repartition(len(rows), "offset").mapInArrow(
                    lambda batches: _copy(batches, target), "offset long").write.format("noop").mode("overwrite").save()
            fs.delete(hadoop(draft).getParent().suffix(f"/.{hadoop(draft).getName()}.crc"), False)  # of the header alone
        elif parts:
            sources = spark.sparkContext._gateway.new_array(hadoop, len(parts))
            for k, (source, _) in enumerate(parts):
                sources[k] = hadoop(source)
            fs.concat(hadoop(draft), sources)  # a store without it refuses; write_report_csv serves those
        fs.delete(hadoop(path), True)
        if not fs.rename(hadoop(draft), hadoop(path)):
            raise OSError(f"cannot rename the report to {path}")
    finally:
        fs.delete(hadoop(folder), True)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K3: persist a star-schema table as parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
