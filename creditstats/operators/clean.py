"""Item cleaning (C1-C17, L10, L11): narrow projections, no shuffle.

Every item gets a `reason` (null = accepted) following the reference's
stage order: film present (C1); for credits, value not junk (C2) and
leading ',' '/' removed (C3); for films, release date present and parsed
(C4-C11) and money cleaned (C12-C17); then the loader's checks: title and
name widths (L10) and the DATE / DECIMAL domains (L11).

Film items and credit items are cleaned by separate functions, so each
generated stage holds only its own rules (the date and money regexes are
never compiled into the credit path), and the date and money rules are
staged projections whose regexes run once per row.

Which rejected items still create their film row matters (L7): an item
whose title is too long never finds its film; a credit whose name is too
long, or a film item whose write fails, does leave the film row behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..schema import MOVIE

FILM_MISSING = "film_missing"
NAME_JUNK = "name_junk"
FILM_TOO_LONG = "film_too_long"
NAME_TOO_LONG = "name_too_long"
OUT_OF_DOMAIN = "out_of_domain"

# Reasons after which the film row was already written by the loader.
FILM_ROW_KEPT = (NAME_TOO_LONG, OUT_OF_DOMAIN)


def _own_code(df: DataFrame) -> DataFrame:
    """The same rows and partitions. What stands before and after gets
    generated methods of its own: one of over 8,000 bytes is never compiled
    by the JVM, but interpreted."""
    return df.coalesce(2 ** 20)  # no more partitions than there are, and nothing moves


def clean_film_items(films: DataFrame) -> DataFrame:
    """schema.FILM_ITEMS -> seq, page_id, film, movie_key, budget,
    box_office (decimal(12,6) millions), release_date (date), reason, and of
    items with a reason the raw texts as JSON."""
    staged = dates.with_release_date(films, "release_date", "__date_text", "__date_reason")
    staged = _own_code(staged.withColumn("__date", dates.to_date_checked(F.col("__date_text"))))
    staged = _own_code(money.with_money(staged, "budget", "__budget", "__budget_bad"))
    staged = money.with_money(staged, "box_office", "__box", "__box_bad")
    film = F.col("film")
    domain_bad = ((F.col("__date_text").isNotNull() & F.col("__date").isNull())
                  | F.col("__budget_bad") | F.col("__box_bad"))
    reason = (
        F.when(~text.nonempty(film), F.lit(FILM_MISSING))
        .when(F.col("__date_reason").isNotNull(), F.col("__date_reason"))
        .when(~text.within_width(film, text.NAME_WIDTH["movie"]), F.lit(FILM_TOO_LONG))
        .when(domain_bad, F.lit(OUT_OF_DOMAIN))
    )
    texts = ("budget", "box_office", "release_date")
    cleaned = staged.select(
        "seq", "page_id", "film",
        text.name_key(film).alias("movie_key"),
        F.col("__budget"), F.col("__box"), F.col("__date"), *texts,
        reason.alias("reason"),
    )
    return cleaned.select(
        "seq", "page_id", "film", "movie_key",
        F.col("__budget").alias("budget"),
        F.col("__box").alias("box_office"),
        F.col("__date").alias("release_date"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.to_json(F.struct("film", *texts))).alias("raw"),
    )


def _width(kind):
    return F.when(kind.isin("actor", "director"), F.lit(text.NAME_WIDTH["actor"])).otherwise(
        F.lit(text.NAME_WIDTH["distributor"]))


def clean_credit_items(credits: DataFrame) -> DataFrame:
    """schema.CREDIT_ITEMS -> seq, page_id, kind, film, movie_key, value,
    entity_key, reason, and of items with a reason the raw texts as JSON."""
    staged = credits.withColumn("__value", text.strip_leading_punct(F.col("value")))
    film, raw_value, value, kind = F.col("film"), F.col("value"), F.col("__value"), F.col("kind")
    reason = (
        F.when(~text.nonempty(film), F.lit(FILM_MISSING))
        .when(~text.nonempty(raw_value) | text.is_junk_name(raw_value), F.lit(NAME_JUNK))
        .when(~text.within_width(film, text.NAME_WIDTH["movie"]), F.lit(FILM_TOO_LONG))
        .when(F.char_length(value) > _width(kind), F.lit(NAME_TOO_LONG))
    )
    cleaned = staged.select(
        "seq", "page_id", "kind", "film",
        text.name_key(film).alias("movie_key"),
        "__value", "value",
        text.name_key(value).alias("entity_key"),
        reason.alias("reason"),
    )
    return cleaned.select(
        "seq", "page_id", "kind", "film", "movie_key",
        F.col("__value").alias("value"),
        "entity_key", "reason",
        F.when(F.col("reason").isNotNull(), F.to_json(F.struct("film", "value"))).alias("raw"),
    )


def rows_where(df: DataFrame, cond, *cols) -> DataFrame:
    """The rows of `df` where `cond` holds, projected to `cols`, without a
    filter: one on a cleaning result would be pushed down through the staged
    cleaning projections and repeat every regex in the predicate, which is
    then too large to compile. Exploding a one-element array that is null
    when `cond` fails yields the same rows and keeps the stages."""
    return df.select(F.explode(F.when(cond, F.array(F.struct(*cols)))).alias("_r")).select("_r.*")


def rejects(films_clean: DataFrame, credits_clean: DataFrame) -> DataFrame:
    """Every item the reference drops or loses, with why (schema.REJECTS)."""
    bad = F.col("reason").isNotNull()
    f = rows_where(films_clean, bad, "seq", F.lit(MOVIE).alias("kind"), "reason", "raw")
    c = rows_where(credits_clean, bad, "seq", "kind", "reason", "raw")
    return f.unionByName(c)
