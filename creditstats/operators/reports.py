"""Box-office reports.

Inputs are the star schema's three shapes:

  bridge    (movie_id, entity_id)           distinct credited pairs
  movies    (movie_id, movie, box_office, release_date)
  entities  (entity_id, <name>)             one row per entity

The reference writes each report as dim LEFT JOIN bridge LEFT JOIN movies
WHERE box_office IS NOT NULL, which is an inner join; we state the inner
join directly. Aggregation runs on the entity key, and names are attached
to the aggregated rows afterwards, so the name join touches one row per
entity (or per entity and year) instead of one row per credit. Grouping by
key equals grouping by name because names are unique per key.

Plan shape at scale: one shuffle of the bridge and of the films on
movie_id (sort-merge join; AQE splits a hot film), partial aggregation on
the map side, one shuffle of partial states on the entity key, then a
small join with the entity names (broadcast by Spark only under the size
threshold, sort-merge otherwise).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEC = "decimal(12,6)"

# ---------------------------------------------------------------------------
# Report column names and subtotal labels of the reference.
ENTITY_STATS_COLUMNS = ["box_office_max", "box_office_min", "box_office_avg", "box_office_std", "film_count"]
ROLLUP_COLUMNS = ["release_year", "box_office_max", "box_office_min", "film_count", "box_office_avg", "box_office_std"]
ALL_YEARS = "All years"
ALL_DISTRIBUTORS = "All distributors"
ALL_PRODUCTION_COMPANIES = "All production companies"
# ---------------------------------------------------------------------------


def moments(x: Column) -> tuple[Column, Column, Column]:
    """n, s1 and s2 of a decimal(12,6) column: its count and the sums of its
    values in millionths and of their squares. Mergeable; as fixed-width
    partial aggregates they are combined on the map side."""
    m = (x * F.lit(1000000)).cast("decimal(13,0)")
    return F.count(x), F.sum(m), F.sum((m * m).cast("decimal(28,0)"))


def deviation(n: Column, s1: Column, s2: Column) -> Column:
    """Population standard deviation from exact moments. With s1 = q * n + r,

        n * variance = s2 - q * s1 - r * q - r * r / n

    where all but the last, small term are decimal arithmetic without
    rounding. Every term stays inside decimal(38) up to 1e14 rows; beyond,
    the query fails, with or without ANSI mode. A binary-float accumulator
    can land on the wrong side of a 6th-decimal rounding boundary."""
    whole = "decimal(38,0)"
    n, s1, s2 = n.cast("decimal(15,0)"), s1.cast("decimal(28,0)"), s2.cast(whole)
    r = F.when(n > 0, s1 % n).cast("decimal(15,0)")
    q = F.when(n > 0, (s1 - r) / n).cast("decimal(14,0)")
    most = s2 - (q * s1).cast(whole) - (r * q).cast(whole)
    rest = r.cast("double") * r.cast("double") / n.cast("double")
    variance = (most.cast("double") - rest) / n.cast("double")
    overflow = (n > 0) & most.isNull()
    return F.when(overflow, F.raise_error(F.lit("box-office moments exceed decimal(38)")).cast("double")).otherwise(
        F.sqrt(F.greatest(variance, F.lit(0.0))) / F.lit(1e6))


def mean(n: Column, s1: Column) -> Column:
    """AVG of the decimal(12,6) column with these moments."""
    total = (s1.cast("decimal(22,0)") * F.lit(Decimal("0.000001"))).cast("decimal(22,6)")
    return (total / n.cast("decimal(15,0)")).cast("decimal(16,10)").cast(DEC)


def stddev_pop_exact(x: Column) -> Column:
    """Population standard deviation of a decimal(12,6) column, in one pass."""
    return deviation(*moments(x))


def _std(std: Column) -> Column:
    # IF(STDDEV(x), CAST(STDDEV(x) AS DECIMAL(12,6)), 0): zero or null -> 0
    return F.when(std != 0, std.cast(DEC)).otherwise(F.lit(0).cast(DEC)).alias("box_office_std")


def _stats(box_office: Column, movie: Column) -> dict[str, Column]:
    std = stddev_pop_exact(box_office)  # population form; Spark's stddev is the sample form
    return {
        "box_office_max": F.max(box_office).alias("box_office_max"),
        "box_office_min": F.min(box_office).alias("box_office_min"),
        "box_office_avg": F.avg(box_office).cast(DEC).alias("box_office_avg"),
        "box_office_std": _std(std),
        "film_count": F.count(movie).alias("film_count"),
    }


def credited_facts(bridge: DataFrame, movies: DataFrame, with_year: bool = False) -> DataFrame:
    """Bridge rows joined to films with a known box office (Q3-Q6).

    The not-null filter sits on the film side, so it is pushed into the
    film scan and the join is inner. A bridge with `first_seq` keeps pairs of
    other films with null facts: they count for the first spelling."""
    cols = [F.col("movie_id"), F.col("movie"), F.col("box_office")]
    if with_year:
        cols.append(F.year("release_date").alias("release_year"))
    facts = movies.where(F.col("box_office").isNotNull()).select(*cols)
    spelled = [c for c in bridge.columns if c == "first_seq"]
    return bridge.select("movie_id", "entity_id", *spelled).join(facts, "movie_id", "left" if spelled else "inner")


def _first_seq(joined: DataFrame) -> list[Column]:
    return [F.min("first_seq").alias("first_seq")] if "first_seq" in joined.columns else []


def entity_stats(bridge: DataFrame, movies: DataFrame, entities: DataFrame | None,
                 entity_col: str = "entity") -> DataFrame:
    """Per entity max, min, avg, population std, film count.

    `entities` maps entity_id -> name (column `entity_col`), or entity_id and
    first_seq -> name if the bridge has first_seq; pass None when entity_id
    already is the name."""
    joined = credited_facts(bridge, movies)
    first = _first_seq(joined)
    agg = joined.groupBy("entity_id").agg(*_stats(F.col("box_office"), F.col("movie")).values(), *first)
    if first:
        agg = agg.where(F.col("film_count") > 0)
    if entities is None:
        named = agg.withColumnRenamed("entity_id", entity_col)
    else:
        key = ["entity_id"] + ["first_seq"] * len(first)
        named = agg.join(entities.select(*key, entity_col), key)
    return named.select(entity_col, *ENTITY_STATS_COLUMNS)


def entity_year_rollup(bridge: DataFrame, movies: DataFrame, entities: DataFrame | None,
                       entity_col: str = "entity", all_label: str = ALL_DISTRIBUTORS) -> DataFrame:
    """GROUP BY entity, release_year WITH ROLLUP.

    Subtotals count (entity, film) pairs: a film with two entities counts
    twice in the grand total, as in the reference. A genuine null year
    stays null; only rollup rows get the 'All years' label."""
    joined = credited_facts(bridge, movies, with_year=True)
    first = _first_seq(joined)
    agg = joined.rollup("entity_id", "release_year").agg(
        *_stats(F.col("box_office"), F.col("movie")).values(), *first,
        F.grouping("entity_id").alias("_g_entity"),
        F.grouping("release_year").alias("_g_year"),
    )
    if first:
        # all rows of an entity (one a year) take the first spelling of the entity
        of_entity = Window.partitionBy("entity_id", "_g_entity")
        agg = agg.withColumn("first_seq", F.min("first_seq").over(of_entity)).where(F.col("film_count") > 0)
    if entities is None:
        named = agg.withColumn(entity_col, F.col("entity_id"))
    else:
        # Rollup rows carry a null entity_id and find no name: left join.
        key = ["entity_id"] + ["first_seq"] * len(first)
        named = agg.join(entities.select(*key, entity_col), key, "left")
    return named.select(
        F.when(F.col("_g_entity") == 1, F.lit(all_label)).otherwise(F.col(entity_col)).alias(entity_col),
        F.when(F.col("_g_year") == 1, F.lit(ALL_YEARS))
        .otherwise(F.col("release_year").cast("string")).alias("release_year"),
        *ROLLUP_COLUMNS[1:],
    )


def from_state(state: DataFrame, names: DataFrame, entity_col: str, all_label: str | None) -> DataFrame:
    """R1/R2 (`all_label` None) or R3/R4 from mergeable state: entity_key,
    release_year, n, s1, s2, most, least. `names`: entity_key, `entity_col`."""
    merged = [F.sum(c).alias(c) for c in ("n", "s1", "s2")] + [F.max("most").alias("box_office_max"), F.min("least").alias("box_office_min")]
    n, s1, s2 = (F.col(c) for c in ("n", "s1", "s2"))
    final = {"box_office_max": F.col("box_office_max"), "box_office_min": F.col("box_office_min"), "film_count": n.alias("film_count"),
             "box_office_avg": mean(n, s1).alias("box_office_avg"), "box_office_std": _std(deviation(n, s1, s2))}
    if all_label is None:
        return (state.groupBy("entity_key").agg(*merged).join(names, "entity_key")
                .select(entity_col, *[final[c] for c in ENTITY_STATS_COLUMNS]))
    agg = state.rollup("entity_key", "release_year").agg(*merged, F.grouping("entity_key").alias("_g_entity"),
                                                         F.grouping("release_year").alias("_g_year"))
    return agg.join(names, "entity_key", "left").where("n > 0").select(
        F.when(F.col("_g_entity") == 1, F.lit(all_label)).otherwise(F.col(entity_col)).alias(entity_col),
        F.when(F.col("_g_year") == 1, F.lit(ALL_YEARS)).otherwise(F.col("release_year").cast("string")).alias("release_year"),
        *[final[c] for c in ROLLUP_COLUMNS[1:]])
