"""Importance resampling towards a target distribution.

1. Each text is a bag of hashed runs of one to three words. Every task sums
   its bags into one array of `buckets` counts; the arrays are added up over
   all documents and over all target texts.
2. The log ratio of the two smoothed distributions is an array of `buckets`
   gains, sent to the tasks (its size is fixed). A document's weight is the
   sum of its features' gains; Gumbel noise from a hash of seed and
   identifier makes the highest scores a draw without replacement.
3. The draw is a distributed quickselect. Composite keys (score falling,
   identifier rising, row number) are unique. Each round takes a few random
   pivot keys of the rows still in question, counts in one pass the rows
   before, at and after each, and goes on between the two pivots around the
   k-th key until a pivot is that key. Rounds grow with the logarithm of the
   rows and only pivots and counts reach the driver.
4. Only the winners are sorted and ranked, by a distributed row number.

Scores are written once to the shared folder, so that rounds, winners and
losers read the same rows and a lost executor repeats a file's scan.

Defined results: null and empty texts have no features, weight 0, and are not
drawn. A null identifier draws noise as an empty one and comes last among
ties; rows equal in score and identifier are told apart by their row number.
Repeated rows are rows of their own. An empty table gives no rows; an empty
target counts as T = 0. Long texts are read in blocks. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import row_number_global
from .common import in_arrow, staged
from .word_blocks import LETTERS, word_blocks

BUCKETS = 10_000
PIVOTS = 16
SCORED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                    ("weight", pa.int64()), ("score", pa.int64())])


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features that end in them), by blocks.
    A run's checksum goes on from that of the run without its last word."""
    before: list[bytes] = []
    for new in word_blocks(text, LETTERS):
        words, held = before + new, len(before)
        spaced = [b" " + w for w in words]
        one = list(map(crc32, words))
        two = list(map(crc32, spaced[1:], one))
        three = list(map(crc32, spaced[2:], two))
        found = one[held:] + two[max(held - 1, 0):] + three[max(held - 2, 0):]
        yield len(new), np.array(found, np.int64) % buckets
        before = words[-2:]


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py(), buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    summed = in_arrow(texts.select(F.col(text_col).alias("text")), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in summed.collect():  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the log ratio, smoothed by one."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_source + n) / ((float(s) + 1) * (all_target + n))))
                     for s, t in zip(source, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def judge(row: tuple) -> tuple:
        n_words = n_features = weight = 0
        for n, found in feature_buckets(row[1], len(sent.value)):
            n_words, n_features = n_words + n, n_features + len(found)
            weight += int(sent.value[found].sum())
        return row[0], n_words, n_features, weight, weight + noise(row[0], seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge((i, t.as_py())) for i, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCORED)], schema=SCORED)

    return in_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id long, n_words long, n_features long, weight long, score long")


def composite_key() -> Column:
    """Orders rows by score falling, doc_id rising (null last), row number."""
    return F.struct((-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"),
                    F.coalesce("doc_id", F.lit(0)).alias("c"), F.col("number").alias("d"))


def _literal(key: tuple) -> Column:
    return F.struct(F.lit(key[0]).cast("long").alias("a"), F.lit(key[1]).alias("b"),
                    F.lit(key[2]).cast("long").alias("c"), F.lit(key[3]).cast("long").alias("d"))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The composite key of the k-th row (from 1) of `rows`: score, doc_id,
    number, the last unique."""
    keyed, low, high, upto_low = rows.select("number", composite_key().alias("key")), None, None, 0
    turn = 0
    while True:
        open_ = keyed
        if low is not None:
            open_ = open_.where(F.col("key") > _literal(low))
        if high is not None:
            open_ = open_.where(F.col("key") < _literal(high))
        drawn = open_.orderBy(F.xxhash64("number", F.lit(turn)), "number").limit(pivots).select("key").collect()
        tried = sorted(tuple(r.key) for r in drawn)
        if not tried:
            raise ValueError(f"fewer than {k} rows")
        # rows before each pivot; one is at it, all others are after it
        less = open_.agg(*[F.count_if(F.col("key") < _literal(p)) for p in tried]).first()
        for p, n in zip(tried, less):
            rank = upto_low + n + 1
            if rank == k:
                return p
            if rank < k:
                low, least = p, rank
            else:
                high = p
                break
        upto_low = least if low in tried else upto_low
        turn += 1


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, n_features, weight, score, rank. Of
    the N rows with `min_words` words or more, the floor(percent * N / 100)
    best are drawn and ranked from 1; the others' rank is null."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    scored = staged(scores(docs, gain, seed, id_col, text_col).withColumn("number", F.monotonically_increasing_id()),
                    "resample-scores")
    enough = scored.where(F.col("n_words") >= min_words)
    k = percent * enough.count() // 100
    if not k:
        return scored.drop("number").withColumn("rank", F.lit(None).cast("long"))
    last = _literal(kth_key(enough, k))
    drawn = (F.col("n_words") >= min_words) & (composite_key() <= last)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("number")]
    winners = row_number_global(scored.where(drawn), order, "rank").withColumn("rank", F.col("rank").cast("long"))
    others = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return winners.unionByName(others).drop("number")
