"""Registered queries over the driver tables, one per SURVEY §2 key.

Each function takes (spark, sf_dir) and returns a lazy DataFrame whose
column names match the DuckDB oracle in `plans.oracle_sql`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports
from ..operators.ordering import row_number_global
from ..schema import ACTOR, DIRECTOR, DISTRIBUTOR, PROD_CO
from ..sinks.csv_report import ENTITY_HEADERS
from ..sources.tables import table
from . import roles, star
from .driver_items import driver_items


# --- reports (R1-R4) and their relational pieces (Q1-Q17) ------------------

def entity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_stats(roles.supplier_credits(spark, sf_dir), roles.films(spark, sf_dir),
                                roles.suppliers(spark, sf_dir))


def entity_stats_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16 as a rank column (distributed, no single-partition window)."""
    stats = entity_stats(spark, sf_dir)
    return row_number_global(
        stats,
        [F.desc("box_office_max"), F.desc("box_office_avg"), F.desc("film_count"), F.asc("entity")],
        "rank",
    )


def entity_stats_by_part_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_stats(roles.part_name_credits(spark, sf_dir), roles.films(spark, sf_dir), None)


def entity_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_year_rollup(roles.supplier_credits(spark, sf_dir), roles.films(spark, sf_dir),
                                      roles.suppliers(spark, sf_dir), all_label=reports.ALL_DISTRIBUTORS)


def nation_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entity_year_rollup(roles.nation_credits(spark, sf_dir), roles.films(spark, sf_dir), None,
                                      all_label=reports.ALL_PRODUCTION_COMPANIES)


def left_join_keep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3/Q4: films LEFT JOIN credits keeps films without credits (count 0)."""
    films = roles.films(spark, sf_dir).select("movie_id")
    per_film = (
        table(spark, sf_dir, "lineitem", "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("movie_id"))
        .agg(F.count("*").alias("n_credits"))
    )
    return films.join(per_film, "movie_id", "left").select(
        "movie_id", F.coalesce("n_credits", F.lit(0).cast("bigint")).alias("n_credits")
    )


def join_notnull_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: dim LEFT JOIN bridge LEFT JOIN films WHERE box_office IS NOT NULL;
    Catalyst turns both outer joins into inner joins."""
    dim = roles.suppliers(spark, sf_dir)
    bridge = roles.supplier_credits(spark, sf_dir)
    films = roles.films(spark, sf_dir)
    return (
        dim.join(bridge, "entity_id", "left")
        .join(films, "movie_id", "left")
        .where(F.col("box_office").isNotNull())
        .select("entity", "movie_id", "box_office")
    )


def year_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: YEAR(release_date), films per year."""
    return (
        roles.films(spark, sf_dir)
        .groupBy(F.year("release_date").cast("bigint").alias("release_year"))
        .agg(F.count("*").alias("n_films"))
    )


def report_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the R1 report under its human-readable CSV headers."""
    return entity_stats(spark, sf_dir).toDF(*ENTITY_HEADERS["actor"])


def bridge_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate credits collapse to one bridge row."""
    return roles.supplier_credits(spark, sf_dir)


# --- end to end: driver items -> cleaning -> star schema -> R1..R4 ---------

def _star(spark: SparkSession, sf_dir: str, kind: str) -> star.Star:
    """The lazy star whose credits are those a report reads, of one kind."""
    return star.build_star(*driver_items(spark, sf_dir, (kind,)))


def film_actor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.actor_report(_star(spark, sf_dir, ACTOR))


def film_director_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.director_report(_star(spark, sf_dir, DIRECTOR))


def film_distributor_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.distributor_report(_star(spark, sf_dir, DISTRIBUTOR))


def film_prodco_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.prodco_report(_star(spark, sf_dir, PROD_CO))


REGISTRY = {
    "film_actor_report": film_actor_report,
    "film_director_report": film_director_report,
    "film_distributor_rollup": film_distributor_rollup,
    "film_prodco_rollup": film_prodco_rollup,
    "entity_stats": entity_stats,
    "entity_stats_sorted": entity_stats_sorted,
    "entity_stats_by_part_name": entity_stats_by_part_name,
    "entity_year_rollup": entity_year_rollup,
    "nation_year_rollup": nation_year_rollup,
    "left_join_keep_all": left_join_keep_all,
    "join_notnull_inner": join_notnull_inner,
    "year_extract": year_extract,
    "report_headers": report_headers,
    "bridge_distinct": bridge_distinct,
}
