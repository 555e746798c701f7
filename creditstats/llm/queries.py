"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe as _bpe
from . import exact_dedup as _exact
from . import html_layout as _html
from . import importance_resampling as _resampling
from . import jaccard_join as _jaccard
from . import mixing as _mixing
from . import simhash_join as _simhash
from . import spotsigs as _spots
from . import substring_dedup as _substring
from . import token_alignment as _alignment
from . import toxicity as _toxicity
from . import url_reputation as _url
from . import warc_zip as _warc
from .common import read

def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# The rules of the URL query, host and path.
URL_RULES = [_url.Rule("com", "/", "allow"), _url.Rule("example.com", "/en/", "block"),
             _url.Rule("www.example.com", "/en/", "allow"), _url.Rule("net", "/es/", "block"),
             _url.Rule("net", "/fr/", "block")]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _substring.dedup_substrings(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html.extract(read(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    made = _bpe.round_trip(read(spark, sf_dir, "documents"), path)
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return _toxicity.score(docs, _toxicity.train(docs, read(spark, sf_dir, "labels")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the quality of the document of its number."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return _url.filter_urls(pages, outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _spots.neighbours(read(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        _spots.fingerprint_text(F.col("spots")).alias("fingerprint"),
        _spots.fingerprint_text(F.col("edited_spots")).alias("edited_fingerprint"),
        _spots.likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        _spots.likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = _mixing.mix(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", F.col("pattern_size").alias("source_size"), "target", "taken", "repeats")


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warc.round_trip(spark, read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.similarity_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.similarity_counts(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return _alignment.align(read(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", _simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


REGISTRY = {f.__name__: f for f in (op1_substring_dedup, op2_html_layout, op3_bpe, op4_toxicity, op5_exact_dedup, op6_url_filter, op7_spotsigs, op8_source_mix, op9_warc_zip,
                                    op10_jaccard_join, op10_jaccard_links, op11_token_alignment, op12_importance_resampling, op13_simhash)}
