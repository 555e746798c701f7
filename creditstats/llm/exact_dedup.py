"""Exact deduplication as a stateful stream.

1. A log of (identifier, digest, byte length, content locator) is written;
   it holds no text.
2. A Structured Streaming query folds the log into keyed state in RocksDB
   (on disk, checkpointed to the shared folder, no expiry): per digest the
   largest identifier with its locator, and the number of rows. A restarted
   query goes on from its checkpoint.
3. The state is read back through the state data source.
4. On hits (digests seen more than once) the full bytes are compared: all
   texts of a digest are equal exactly when their least and greatest are.
   A bit filter of fixed size over the hits keeps texts without a copy out of
   the shuffle (it lets some pass, never holds a hit back). Each map task
   folds its copies before the shuffle, so a hot group of copies sends one
   text per task. Digests with different texts are grouped again by their
   bytes.

DataFrame operations only.

Defined results: null text counts as empty text. A null identifier sorts
below all others. Rows that agree in text and identifier are told apart by
their locator, so one row of each group is kept. An empty table gives an
empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, scratch, session_conf, staged, with_locator

# RocksDB keeps the state on disk. Space is not reserved ahead: many small stores would reserve more than they hold.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # all stores of an executor share this memory
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # no store stays open in an executor when its task has ended
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
FILTER_WORDS = 1 << 17  # 64-bit words of the bit filter, at most so many rows are broadcast
RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256", "locator", "keep_locator")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, files_per_trigger: int = 10_000) -> DataFrame:
    """One row per input row: RESULT. `locator` is (file, row) of the row."""
    located = with_locator(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "locator")
    return _exact_dedup(located, "doc_id", "text", digest, files_per_trigger)


def _exact_dedup(located: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] = sha256,
                 files_per_trigger: int = 10_000) -> DataFrame:
    spark = located.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = located.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), digest(text).alias("digest"),
        F.octet_length(text).alias("n_bytes"), "locator")

    log_path = scratch(spark, "dedup-log")
    entries = rows.select("doc_id", "digest", "n_bytes", "locator", sha256(F.col("text")).alias("text_sha256"))
    schema = entries.schema
    entries.write.parquet(log_path)
    groups = staged(_fold(spark, log_path, schema, files_per_trigger), "dedup-groups")

    key = ["digest", "n_bytes"]
    mixed = staged(
        _maybe_hits(rows.select(*key, "text"), groups.where("group_size > 1"), key).groupBy(*key)
        .agg(F.min("text").alias("_least"), F.max("text").alias("_most"))
        .where(F.col("_least") != F.col("_most")).select(*key), "dedup-mixed")
    log = spark.read.schema(schema).parquet(log_path)
    if mixed.isEmpty():
        return _judged(log.join(groups, key))
    by_text = [*key, "text"]
    again = rows.join(mixed, key).withColumn("text_sha256", sha256(F.col("text")))
    best = again.groupBy(*by_text).agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size"))
    return _judged(log.join(mixed, key, "left_anti").join(groups, key)).unionByName(_judged(again.join(best, by_text)))


def _maybe_hits(rows: DataFrame, hits: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key the bit filter over the hits holds, with all of the
    hits' own."""
    place = F.xxhash64(*key)
    word, bit = F.pmod(place, F.lit(FILTER_WORDS)), F.shiftright(place, 32).bitwiseAND(F.lit(63)).cast("int")
    one = F.expr("shiftleft(1L, _bit)")
    bits = hits.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(one).alias("_bits"))
    placed = rows.withColumns({"_word": word, "_bit": bit})
    return placed.join(F.broadcast(bits), "_word").where(F.col("_bits").bitwiseAND(one) != 0).select(*rows.columns)


def _fold(spark, log_path: str, schema, files_per_trigger: int) -> DataFrame:
    """The streaming fold of the log; returns its final state."""
    checkpoint = scratch(spark, "dedup-state")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(log_path)
              .groupBy("digest", "n_bytes")
              .agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size")))
    with session_conf(spark, STATE_CONF):
        query = (stream.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.digest", "key.n_bytes", F.col("value.max").alias("keep"),
                        F.col("value.count").alias("group_size"))


def _judged(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"), "text_sha256", "locator",
        F.col("keep.locator").alias("keep_locator"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    name = free_name(docs, "_locator")
    located = with_locator(docs, name)
    rows = located.select(id_col, text_col, F.col(name).alias("locator"))
    dropped = _exact_dedup(rows, id_col, text_col).where(~F.col("kept")).select(F.col("locator").alias(name))
    return located.join(dropped, name, "left_anti").select(*[f"`{c}`" for c in docs.columns])
