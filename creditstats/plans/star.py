"""End to end: items -> cleaned items -> star schema -> four reports.

The star schema is nine tables: films, four dimensions, four bridges of ids,
plus the rejects. `write_star` persists them and `run_reports` reads them
back, so the reports never recompute the cleaning and a lost executor only
recomputes from a written table. A single lazy report reads credited pairs by
spelling instead (one hash aggregation over the credits, whose exchange feeds
both the statistics and the names). Either way the report itself is
`operators.reports`.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clean, model, reports
from ..schema import ACTOR, DIRECTOR, DISTRIBUTOR, PROD_CO
from ..operators.partitioning import materialize
from ..sinks import csv_report


# Kind -> dimension table, its id and name columns, bridge table.
TABLES = {
    ACTOR: ("actors", "actor_id", "actor", "castlist"),
    DIRECTOR: ("directors", "director_id", "director", "filmdirectors"),
    DISTRIBUTOR: ("distributors", "distributor_id", "distributor", "filmdistributors"),
    PROD_CO: ("productionco", "prod_co_id", "prod_co", "filmprodco"),
}


@dataclass
class Star:
    movies: DataFrame
    dimensions: DataFrame
    bridges: DataFrame
    rejects: DataFrame | None = None    # absent when read back from written tables
    facts: DataFrame | None = None      # films with accepted facts, from film items only (lazy reports)
    spellings: DataFrame | None = None  # credited pairs by spelling (lazy reports)


def build_star(film_items: DataFrame, credit_items: DataFrame, materialize_cleaned: bool = False) -> Star:
    """Lazy star schema. With materialize_cleaned, the cleaned items are
    written once (shared folder) and everything reads them, instead of
    re-running the cleaning: the choice for the persisted runs below."""
    films = clean.clean_film_items(film_items)
    credits = clean.clean_credit_items(credit_items)
    if materialize_cleaned:
        films = materialize(films, "films-clean")
        credits = materialize(credits, "credits-clean")
    return Star(model.build_movies(films, credits), model.build_dimensions(credits),
                model.build_bridges(credits), clean.rejects(films, credits), model.build_facts(films),
                model.build_spellings(credits))


def _report_inputs(star: Star, kind: str, name_col: str):
    if star.spellings is None:
        bridge = model.bridge(star.bridges, kind).select("movie_id", "entity_id")
        names = model.dimension(star.dimensions, kind).select("entity_id", F.col("entity").alias(name_col))
        return bridge, star.movies.select("movie_id", "movie", "box_office", "release_date"), names
    spelled = star.spellings.where(F.col("kind") == kind).select(
        F.col("movie_key").alias("movie_id"), F.col("entity_key").alias("entity_id"), "value", "seq")
    bridge = spelled.groupBy("movie_id", "entity_id").agg(F.min("seq").alias("first_seq"))
    names = spelled.select("entity_id", F.col("seq").alias("first_seq"), F.col("value").alias(name_col))
    movies = star.facts.select(F.col("movie_key").alias("movie_id"), "movie", "box_office", "release_date")
    return bridge, movies, names


def tables_of(star: Star) -> dict[str, DataFrame]:
    """The nine tables, by name."""
    out = {"movies": star.movies.select("movie_id", "movie", "budget", "box_office", "release_date")}
    for kind, (dim, id_col, name_col, bridge) in TABLES.items():
        out[dim] = model.dimension(star.dimensions, kind).select(
            F.col("entity_id").alias(id_col), F.col("entity").alias(name_col))
        out[bridge] = model.bridge(star.bridges, kind).select("movie_id", F.col("entity_id").alias(id_col))
    return out


def stored(star: Star) -> Star:
    """The star with films, dimensions and bridges (their kind and ids) written once."""
    return Star(materialize(star.movies, "star-movies"), materialize(star.dimensions, "star-dimensions"),
                materialize(star.bridges.select("kind", "movie_id", "entity_id"), "star-bridges"), star.rejects)


def check_star(star: Star) -> DataFrame:
    """L12 on the built tables: check, n_bad. UNIQUE and FOREIGN KEY per
    table, and surrogate ids shared by different keys.

    Bridges and films meet by film id, dealt once: pairs held twice, ids held
    twice, ids with two different key hashes, and children without a film.
    Bridges, counted by entity id before they move, meet the dimensions alike.
    What moves of a bridge row is its kind and its ids."""
    salt = F.lit("other hash than the id's")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")

    def n(cond: Column, value: Column | None = None) -> Column:
        """How many rows meet the condition, or the sum of their values."""
        return F.coalesce(F.sum(F.when(cond, F.lit(1) if value is None else value)), zero).cast("bigint")

    def listed_as(rows: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
        return rows.select(F.explode(F.array(*[F.struct(name.alias("check"), F.col(c).alias("n_bad")) for name, c in checks])).alias("c")).select("c.*")

    def named(pattern: str) -> Column:
        """The check's name by kind."""
        out = F.lit(None).cast("string")
        for kind, (dim, id_col, name_col, bridge) in TABLES.items():
            out = F.when(F.col("kind") == kind, pattern.format(dim=dim, id=id_col, name=name_col, bridge=bridge)).otherwise(out)
        return out

    collides = F.col("low") != F.col("high")
    hashes = [F.min("h").alias("low"), F.max("h").alias("high")]
    by_film = star.movies.select("movie_id", F.lit(None).cast("string").alias("kind"), none.alias("entity_id"), F.xxhash64(salt, "movie_key").alias("h"))
    by_film = by_film.unionByName(star.bridges.select("movie_id", "kind", "entity_id", none.alias("h"))).repartition("movie_id")
    pairs = by_film.groupBy("movie_id", "kind", "entity_id").agg(F.count("*").alias("n"), *hashes)
    of_kind = [(k, F.col("kind") == kind) for k, kind in enumerate(TABLES)]
    films = pairs.groupBy("movie_id").agg(
        n(F.col("kind").isNull(), F.col("n")).alias("parents"), F.min("low").alias("low"), F.max("high").alias("high"),
        *[n(held, F.col("n")).alias(f"children_{k}") for k, held in of_kind], *[n(held & (F.col("n") > 1)).alias(f"twice_{k}") for k, held in of_kind])
    films = films.agg(n(F.col("parents") > 1).alias("ids"), n(collides).alias("collisions"),
                      *[n(F.col("parents") == 0, F.col(f"children_{k}")).alias(f"orphans_{k}") for k, _ in of_kind],
                      *[F.coalesce(F.sum(f"twice_{k}"), zero).alias(f"twice_{k}") for k, _ in of_kind])
    bridges = [t[3] for t in TABLES.values()]
    titles = star.movies.groupBy("movie").count().agg(n(F.col("count") > 1).alias("titles"))

    by_entity = star.dimensions.select("kind", "entity_id", F.lit(1).alias("parent"), F.lit(0).alias("child"), F.xxhash64(salt, "entity_key").alias("h"))
    by_entity = by_entity.unionByName(star.bridges.select("kind", "entity_id", F.lit(0).alias("parent"), F.lit(1).alias("child"), none.alias("h")))
    entities = by_entity.groupBy("kind", "entity_id").agg(F.sum("parent").alias("parents"), F.sum("child").alias("children"), *hashes)
    entities = entities.groupBy("kind").agg(n(F.col("parents") > 1).alias("ids"), n(collides).alias("collisions"),
                                            n(F.col("parents") == 0, F.col("children")).alias("orphans"))
    names = star.dimensions.groupBy("kind", "entity").count().groupBy("kind").agg(n(F.col("count") > 1).alias("names"))
    counted = reduce(DataFrame.unionByName, [
        listed_as(films, (F.lit("movies.movie_id unique"), "ids"), (F.lit("movies.movie_id collisions"), "collisions"),
                  *[(F.lit(f"{b} -> movies"), f"orphans_{k}") for k, b in enumerate(bridges)],
                  *[(F.lit(f"{b} pairs unique"), f"twice_{k}") for k, b in enumerate(bridges)]),
        listed_as(titles, (F.lit("movies.movie unique"), "titles")),
        listed_as(entities, (named("{dim}.{id} unique"), "ids"), (F.lit("entity_id collisions"), "collisions"), (named("{bridge} -> {dim}"), "orphans")),
        listed_as(names, (named("{dim}.{name} unique"), "names"))]).groupBy("check").agg(F.sum("n_bad").alias("n_bad"))
    # a check of an empty table has no keys: it is listed with none bad
    listed = ["movies.movie_id unique", "movies.movie unique", "movies.movie_id collisions", "entity_id collisions"]
    for dim, id_col, name_col, bridge in TABLES.values():
        listed += [f"{dim}.{id_col} unique", f"{dim}.{name_col} unique", f"{bridge} pairs unique", f"{bridge} -> movies", f"{bridge} -> {dim}"]
    checks = star.movies.sparkSession.createDataFrame([(c,) for c in listed], "check string")
    return checks.join(counted, "check", "left").select("check", F.coalesce("n_bad", F.lit(0).cast("bigint")).alias("n_bad"))


def actor_report(star: Star) -> DataFrame:
    """Per actor."""
    return reports.entity_stats(*_report_inputs(star, ACTOR, "actor"), entity_col="actor")


def director_report(star: Star) -> DataFrame:
    """R2: per director."""
    return reports.entity_stats(*_report_inputs(star, DIRECTOR, "director"), entity_col="director")


def distributor_report(star: Star) -> DataFrame:
    """Per distributor and year, with rollup subtotals."""
    return reports.entity_year_rollup(*_report_inputs(star, DISTRIBUTOR, "distributor"),
                                      entity_col="distributor", all_label=reports.ALL_DISTRIBUTORS)


def prodco_report(star: Star) -> DataFrame:
    """Per production company and year, with rollup subtotals."""
    return reports.entity_year_rollup(*_report_inputs(star, PROD_CO, "prod_co"),
                                      entity_col="prod_co", all_label=reports.ALL_PRODUCTION_COMPANIES)


REPORTS = {
    "by_actor": (actor_report, csv_report.ENTITY_HEADERS["actor"], "actor"),
    "by_director": (director_report, csv_report.ENTITY_HEADERS["director"], "director"),
    "by_distributor": (distributor_report, csv_report.ROLLUP_HEADERS["distributor"], "distributor"),
    "by_production_company": (prodco_report, csv_report.ROLLUP_HEADERS["prod_co"], "prod_co"),
}


# report -> kind, entity column, label of the grand total (None: no rollup)
REPORT_KINDS = {
    "by_actor": (ACTOR, "actor", None),
    "by_director": (DIRECTOR, "director", None),
    "by_distributor": (DISTRIBUTOR, "distributor", reports.ALL_DISTRIBUTORS),
    "by_production_company": (PROD_CO, "prod_co", reports.ALL_PRODUCTION_COMPANIES),
}


def write_star(star: Star, out_dir: str) -> None:
    """K3: persist the nine tables (parquet) and the rejects."""
    star = stored(star)
    for name, df in tables_of(star).items():
        csv_report.write_table(df, os.path.join(out_dir, name))
    csv_report.write_table(star.rejects, os.path.join(out_dir, "rejects"), partition_by=["reason"])


def read_star(spark: SparkSession, out_dir: str) -> Star:
    """The written tables as a Star for reports and checks."""
    def read(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(out_dir, name))

    dims = [read(dim).select(F.lit(kind).alias("kind"), F.col(id_col).alias("entity_id"),
                             text.name_key(F.col(name_col)).alias("entity_key"), F.col(name_col).alias("entity"))
            for kind, (dim, id_col, name_col, _) in TABLES.items()]
    bridges = [read(bridge).select(F.lit(kind).alias("kind"), "movie_id", F.col(id_col).alias("entity_id"))
               for kind, (_, id_col, _, bridge) in TABLES.items()]
    movies = read("movies").withColumn("movie_key", text.name_key(F.col("movie")))
    return Star(movies, reduce(DataFrame.unionByName, dims), reduce(DataFrame.unionByName, bridges))


def write_reports(star: Star, out_dir: str, one_file: bool = True) -> dict[str, str]:
    """The four CSV reports, sorted; report -> path. With `one_file` each is
    one file (the file system must be a shared mount or HDFS), else a folder
    of sorted parts."""
    paths = {}
    for name, (fn, headers, entity_col) in REPORTS.items():
        df = fn(star)
        order = ([F.desc("box_office_max"), F.desc("box_office_avg"), F.desc("film_count"), F.asc(entity_col)]
                 if "release_year" not in df.columns else [F.asc(entity_col), F.asc("release_year")])
        paths[name] = os.path.join(out_dir, f"{name}.csv")
        write = csv_report.write_one_csv if one_file else csv_report.write_report_csv
        write(df, paths[name], headers=headers, sort_cols=order)
    return paths


def run_reports(spark: SparkSession, film_items: DataFrame, credit_items: DataFrame,
                out_dir: str) -> dict[str, str]:
    """K4: build and persist the star schema once, then write the four
    CSV reports from the persisted tables. Returns report -> path."""
    tables = os.path.join(out_dir, "tables")
    write_star(build_star(film_items, credit_items, materialize_cleaned=True), tables)
    return write_reports(read_star(spark, tables), out_dir)


def run_from_pages(spark: SparkSession, pages: DataFrame, out_dir: str) -> dict[str, str]:
    """Pages -> reports. The HTML extraction (the costliest step) runs once
    and is written; film and credit items are two projections of it."""
    from ..sources import pages as P

    extracted = materialize(P.extract(pages), "pages-extracted")
    return run_reports(spark, P.film_items(extracted), P.credit_items(extracted), out_dir)
