"""WARC records in ZIP packages: writing, and reading by byte ranges.

A package is a ZIP file with stored members: archive/data.warc.gz (one gzip
member a record) and indexes/index.cdx (one line a record: its page, type,
offset and length in the archive). A reader never extracts or scans a
package: it reads the tail, follows the end record (or its ZIP64 form) to
the central directory, locates the stored members, reads the index, and then
reads single records by range.

Writing: equal payloads are found by digest over small rows (each map task
folds its copies, so hot payloads are no hot group); of equal payloads of at
least `min_revisit_bytes` the record with the smallest page_id is the
response and the others are revisits that name it. The payloads move once,
dealt evenly, and each task streams one package into the shared folder. The
written paths are themselves a table: what a failed attempt leaves behind is
in no table and never read. Folders are opened through pyarrow.fs (local,
HDFS, S3, GCS), by the URI of the shared folder.

Reading: one task a package lists its records, the list is dealt evenly, and
tasks range-read the records of their share, in package order.

Defined results: a null payload is the empty payload; a null url is empty; a
null page_id counts as larger than any other and reads back as null; rows
equal in page_id and payload are told apart by their locator, so one is the
response; an empty table gives no package and no record; further columns are
not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, scratch, staged, with_locator

INDEXES_A_TASK = 16
BYTES_A_TASK = 32 << 20  # as stored, compressed

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# Signatures and layouts of the ZIP format (little endian).
END, END64, LOCATOR64, MEMBER, LOCAL = (b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
END_LAYOUT, END64_LAYOUT, LOCATOR64_LAYOUT = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
MEMBER_LAYOUT, LOCAL_LAYOUT = "<4s6H3L5H2L", "<4s5H3L2H"
ZIP64_FIELD, FULL16, FULL32, STORED = 1, 0xFFFF, 0xFFFFFFFF, 0

REFS = "package string, base long, offset long, length long, page_id long"
RECORDS = ("page_id long, url string, record_type string, record_id string, refers_to_id string, refers_to long, "
           "payload_digest string, payload_bytes long, payload binary")


def open_folder(uri: str):
    """(file system, path) of a path with or without a scheme."""
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---- records


def record_id(page_id: int | None, key: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{key & 0xFFFFFFFFFFFFFFFF:016x}>"


def page_of(record: str) -> int | None:
    part = record.split(":")[2]
    return int(part) if part else None


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(url: str, rid: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {rid}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url, safe=chr(33) + '#$%&()*+,/:;=?@[]~' + chr(39))}",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[4:4] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_record(raw: bytes) -> dict:
    """Fields of RECORDS from one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    http_head, _, body = block.partition(b"\r\n\r\n")
    size = int(_fields(http_head)["content-length"])
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    kind = warc["warc-type"]
    if kind == "response" and (len(body) != size or payload_digest(body) != digest):
        raise ValueError(f"record {warc['warc-record-id']} is damaged")
    target = warc.get("warc-refers-to")
    return {"page_id": page_of(warc["warc-record-id"]), "url": warc["warc-target-uri"], "record_type": kind,
            "record_id": warc["warc-record-id"], "refers_to_id": target,
            "refers_to": page_of(target) if target else None, "payload_digest": digest, "payload_bytes": size,
            "payload": body if kind == "response" else None}


# ---- writing


def mark_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, key (unique per row), refers_to_page and
    refers_to_key (null for responses)."""
    rows = with_locator(pages.select("page_id", "url", "html")).select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"), F.xxhash64("_locator").alias("key"))
    seen = rows.select("page_id", "key", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
    seen = staged(seen.where(F.col("n") >= min_revisit_bytes), "warc-digests")
    first = (seen.groupBy("digest", "n")
             .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "key")).alias("first"), F.count("*").alias("c"))
             .where("c > 1"))
    revisits = seen.join(first, ["digest", "n"]).where(F.col("key") != F.col("first.key")).select(
        "key", F.col("first.page_id").alias("refers_to_page"), F.col("first.key").alias("refers_to_key"))
    return rows.join(revisits, "key", "left")


def write_packages(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write `pages` (page_id, url, html) as packages; returns the table of
    their paths (package, records)."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs  # noqa: F401

        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        fs, root = open_folder(folder)
        fs.create_dir(root, recursive=True)
        name, lines, offset = f"pages-{uuid.uuid4().hex}.zip", [], 0
        with fs.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            with z.open(ARCHIVE, "w", force_zip64=True) as archive:
                while batch is not None:
                    for r in batch.to_pylist():
                        rid = record_id(r["page_id"], r["key"])
                        target = None if r["refers_to_key"] is None else record_id(r["refers_to_page"], r["refers_to_key"])
                        data = gzip.compress(warc_record(r["url"], rid, r["payload"], target, date), 6, mtime=0)
                        archive.write(data)
                        lines.append(json.dumps({"page_id": r["page_id"], "offset": offset, "length": len(data)}))
                        offset += len(data)
                    batch = next((b for b in batches if b.num_rows), None)
            z.writestr(INDEX, "\n".join(lines))
        yield pa.RecordBatch.from_pydict({"package": [f"{folder}/{name}"], "records": [len(lines)]})

    return staged(in_arrow(mark_revisits(pages, min_revisit_bytes), write, "package string, records long"), "warc-packages")


# ---- reading


def _at(f, offset: int, length: int) -> bytes:
    f.seek(offset)
    return f.read(length)


def central_directory(f, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Members of a package: name -> (method, offset of its local header,
    stored size, full size). `f` is a seekable file of `size` bytes."""
    tail_at = max(0, size - FULL16 - struct.calcsize(END_LAYOUT))
    tail = _at(f, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:  # a comment may hold the signature: the true end record's comment ends the file
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP package")
    _, _, _, _, count, length, start, _ = struct.unpack_from(END_LAYOUT, tail, at)
    if FULL16 == count or FULL32 in (length, start):
        place = tail_at + at - struct.calcsize(LOCATOR64_LAYOUT)
        sign, _, end64, _ = struct.unpack(LOCATOR64_LAYOUT, _at(f, place, struct.calcsize(LOCATOR64_LAYOUT)))
        if sign == LOCATOR64:
            *_, count, length, start = struct.unpack(END64_LAYOUT, _at(f, end64, struct.calcsize(END64_LAYOUT)))
    data, members, pos = _at(f, start, length), {}, 0
    for _ in range(count):
        (sign, _, _, _, method, _, _, _, packed, full, n_name, n_extra, n_comment, _, _, _, where) = struct.unpack_from(
            MEMBER_LAYOUT, data, pos)
        if sign != MEMBER:
            raise ValueError("the central directory is damaged")
        pos += struct.calcsize(MEMBER_LAYOUT)
        name, extra = data[pos:pos + n_name].decode("utf-8"), data[pos + n_name:pos + n_name + n_extra]
        pos += n_name + n_extra + n_comment
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<2H", extra)
            if tag == ZIP64_FIELD:  # holds, in this order, only the values that did not fit
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                where = next(wide) if where == FULL32 else where
            extra = extra[4 + n:]
        members[name] = (method, where, packed, full)
    return members


def data_start(f, member: tuple[int, int, int, int]) -> int:
    """Offset of a stored member's first byte."""
    method, where, _, _ = member
    if method != STORED:
        raise ValueError("a compressed member cannot be read by range")
    head = struct.unpack(LOCAL_LAYOUT, _at(f, where, struct.calcsize(LOCAL_LAYOUT)))
    if head[0] != LOCAL:
        raise ValueError("no local header where the directory says")
    return where + struct.calcsize(LOCAL_LAYOUT) + head[-2] + head[-1]


def list_records(packages: DataFrame) -> DataFrame:
    """The index of every package: REFS, one row a record."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column(0).to_pylist():
                fs, path = open_folder(package)
                with fs.open_input_file(path) as f:
                    members = central_directory(f, f.size())
                    base = data_start(f, members[ARCHIVE])
                    index = _at(f, data_start(f, members[INDEX]), members[INDEX][2]).decode()
                refs = [json.loads(x) for x in index.split("\n") if x]
                yield pa.RecordBatch.from_pydict(
                    {"package": [package] * len(refs), "base": [base] * len(refs), "offset": [x["offset"] for x in refs],
                     "length": [x["length"] for x in refs], "page_id": pa.array([x["page_id"] for x in refs], pa.int64())})

    # the paths are small whatever the indexes hold, so their number sets the tasks
    tasks = max(packages.sparkSession.sparkContext.defaultParallelism, -(-packages.count() // INDEXES_A_TASK))
    return in_arrow(packages.select("package").repartition(tasks, "package"), look, REFS)


def read_records(refs: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of the listed records, each read by its own byte range."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("record_id", pa.string()), ("refers_to_id", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f, out, held = None, None, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["package"] != opened:
                    if f:
                        f.close()
                    fs, path = open_folder(r["package"])
                    f, opened = fs.open_input_file(path), r["package"]
                record = parse_record(gzip.decompress(_at(f, r["base"] + r["offset"], r["length"])))
                if not payloads:
                    record["payload"] = None
                out.append(record)
                held += len(record["payload"] or b"") + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if f:
            f.close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    # a reference is small whatever its record weighs, so the stored bytes set the tasks
    refs = staged(refs, "warc-refs")
    stored = refs.agg(F.sum("length")).first()[0] or 0
    tasks = max(refs.sparkSession.sparkContext.defaultParallelism, -(-stored // BYTES_A_TASK))
    spread = refs.repartition(tasks, "package", F.shiftright("offset", 22))
    return in_arrow(spread.sortWithinPartitions("package", "offset"), fetch, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write `pages` as packages and read every record back."""
    return read_records(list_records(write_packages(pages, min_revisit_bytes=min_revisit_bytes)), payloads=False)
