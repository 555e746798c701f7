"""Role mapping of the driver tables onto the film star schema.

  films      orders:   o_orderkey -> movie_id, o_totalprice -> box_office
                       (decimal(12,6), millions), o_orderdate -> release_date
  credits    lineitem: distinct (l_orderkey, l_suppkey) -> bridge
  entities   supplier: s_suppkey -> entity_id, s_name -> name
             part:     p_name (shared by many parts) as a name-keyed entity
             nation:   n_name of the supplier as a company-like entity

Every frame here is a lazy projection of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

DEC = "decimal(12,6)"


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderdate").select(
        F.col("o_orderkey").alias("movie_id"),
        F.col("o_orderkey").cast("string").alias("movie"),
        F.col("o_totalprice").cast(DEC).alias("box_office"),
        F.to_date("o_orderdate").alias("release_date"),
    )


def supplier_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (film, supplier) pairs. The distinct runs before the join
    with films: map-side partial aggregation collapses repeated pairs, and
    the later join shuffle on movie_id sees each pair once, so a hot film is
    a skewed join partition that AQE can split."""
    return (
        table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
        .select(F.col("l_orderkey").alias("movie_id"), F.col("l_suppkey").alias("entity_id"))
        .distinct()
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("entity")
    )


def part_name_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (film, part name): the part name is the entity key."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .select(F.col("l_orderkey").alias("movie_id"), F.col("p_name").alias("entity_id"))
        .distinct()
    )


def nation_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (film, supplier nation name)."""
    pairs = supplier_credits(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return (
        pairs.join(sup, pairs.entity_id == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
        .select("movie_id", F.col("n_name").alias("entity_id"))
        .distinct()
    )
