"""The corpus pipeline: stages over `documents`, each written and read again.

Every stage but the last returns the columns of documents; the last returns
the encoded corpus (doc_id, n_tokens, ids) with the text decoded from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditstats.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from creditstats.llm.common import read, staged
from creditstats.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The model learns from the labels of the
    documents it is given."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the text they decode to."""
    path = tokenizer_path()
    made = bpe.round_trip(docs, path)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources", mix_sources), ("BPE encoding and decoding", encode_and_decode)]

# The toxicity model and the seeded mix are not SQL; a test holds the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
