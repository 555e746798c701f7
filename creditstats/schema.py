"""Explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Item kinds (the reference's five item classes).
MOVIE, ACTOR, DIRECTOR, DISTRIBUTOR, PROD_CO = "movie", "actor", "director", "distributor", "prod_co"
CHILD_KINDS = (ACTOR, DIRECTOR, DISTRIBUTOR, PROD_CO)
KINDS = (MOVIE,) + CHILD_KINDS

# Arrival order of items: page, kind and position packed into one decimal. It
# is unique and, unlike a struct, of fixed width, so that its minimum and
# maximum are hash-aggregated.
SEQ = T.DecimalType(38, 0)
LONG_PAGE = 90_000_000  # pages whose items' numbers fit 64 bits


def item_seq(page: Column, kind: Column | int, pos: Column | int) -> Column:
    """Items in order of page, kind (0 to 9), pos (0 to 10**10 - 1). Where the
    number fits 64 bits it is made of whole numbers, which cost far less than
    decimals of this width."""
    whole = (page.cast("bigint") * 10 + kind) * F.lit(10 ** 10) + pos
    wide = (page.cast("decimal(19,0)") * 10 + kind) * F.lit(10 ** 10) + pos
    return F.when(page.between(-LONG_PAGE, LONG_PAGE), whole.cast(SEQ)).otherwise(wide.cast(SEQ))


# Film items (the reference's movie item) and credit items (its cast,
# director, distributor and production-company items) are two tables, as
# they have different fields and different cleaning rules. `seq` is one
# total arrival order over both, which makes first-spelling and
# last-write-wins deterministic.
FILM_ITEMS = T.StructType([
    T.StructField("seq", SEQ, False),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("film", T.StringType(), True),
    T.StructField("budget", T.StringType(), True),
    T.StructField("box_office", T.StringType(), True),
    T.StructField("release_date", T.StringType(), True),
])

CREDIT_ITEMS = T.StructType([
    T.StructField("seq", SEQ, False),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("film", T.StringType(), True),
    T.StructField("kind", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])

MONEY = T.DecimalType(12, 6)

MOVIES = T.StructType([
    T.StructField("movie_id", T.LongType(), False),
    T.StructField("movie_key", T.StringType(), False),
    T.StructField("movie", T.StringType(), False),
    T.StructField("budget", MONEY, True),
    T.StructField("box_office", MONEY, True),
    T.StructField("release_date", T.DateType(), True),
])

DIMENSION = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("entity_key", T.StringType(), False),
    T.StructField("entity", T.StringType(), False),
])

BRIDGE = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("movie_key", T.StringType(), False),
    T.StructField("entity_key", T.StringType(), False),
])

REJECTS = T.StructType([
    T.StructField("seq", SEQ, False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("raw", T.StringType(), True),
])
