"""Registered queries for the modelling operators (X12, L1-L12) over whole
driver tables, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clean, model
from ..schema import ACTOR, MOVIE, PROD_CO, item_seq
from ..sources.tables import table
from . import star
from .driver_items import driver_items, order_seq
from .oracle_sql import ITEM_LINES


def _credits(df: DataFrame, seq, film, kind: str, value) -> DataFrame:
    return df.select(seq.alias("seq"), F.lit(None).cast("bigint").alias("page_id"),
                     film.alias("film"), F.lit(kind).alias("kind"), value.alias("value"))


def _title(orderkey):
    return F.concat(F.lit("Order "), orderkey.cast("string"))


def item_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One film item per order, one credit item per (film, value)
    and kind; items and distinct films per kind."""
    films, credits = driver_items(spark, sf_dir)
    items = films.select(F.lit("movie").alias("kind"), "film").unionByName(credits.select("kind", "film"))
    return items.groupBy("kind").agg(F.count("*").alias("n_items"), F.countDistinct("film").alias("n_films"))


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: every word of every document under the canonical key
    (trailing spaces, case and accents ignored): occurrences and spellings."""
    docs = table(spark, sf_dir, "documents", "text")
    words = docs.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("w")).where(F.col("w") != "")
    return words.groupBy(text.name_key(F.col("w")).alias("name_key")).agg(
        F.count("*").alias("n_words"), F.countDistinct("w").alias("n_spellings"))


def _part_variant(name, size):
    return (F.when(size <= 12, F.upper(name))
            .when(size <= 25, F.concat(name, F.lit("   ")))
            .when(size <= 37, F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2))))
            .otherwise(name))


def dim_first_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3: one dimension row per canonical name, spelled as first seen."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    items = _credits(p, F.col("p_partkey"), F.concat(F.lit("Catalogue "), F.col("p_brand")), PROD_CO,
                     _part_variant(F.col("p_name"), F.col("p_size")))
    dims = model.build_dimensions(clean.clean_credit_items(items))
    return dims.select("entity_key", "entity")


def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the latest event's fields by (ts, event_id), nulls kept."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return model.latest_by(ev, ["user_id"], ["ts", "event_id"], ["event_type", "value", "event_id"])


def stub_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A film whose film item was lost keeps a row with null facts when
    credits created it; without credits it does not exist."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    d = F.to_date("o_orderdate")
    films = o.select(
        order_seq(F.col("o_orderkey"), 0, MOVIE).alias("seq"), F.lit(None).cast("bigint").alias("page_id"),
        _title(F.col("o_orderkey")).alias("film"), F.lit(None).cast("string").alias("budget"),
        F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit(" million"))
        .alias("box_office"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("Spring "), F.date_format(d, "yyyy")))
        .otherwise(F.date_format(d, "yyyy-MM-dd")).alias("release_date"),
    )
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    lines = li.join(sup, li.l_suppkey == sup.s_suppkey)
    credits = _credits(lines, order_seq(F.col("l_orderkey"), F.col("l_linenumber"), ACTOR), _title(F.col("l_orderkey")),
                       ACTOR, F.col("s_name"))
    movies = model.build_movies(clean.clean_film_items(films), clean.clean_credit_items(credits))
    return movies.select("movie", "box_office", "release_date")


def _actor_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    lines = li.join(sup, li.l_suppkey == sup.s_suppkey)
    return _credits(lines, order_seq(F.col("l_orderkey"), F.col("l_linenumber"), ACTOR), _title(F.col("l_orderkey")),
                    ACTOR, F.col("s_name"))


def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the item log twice gives the same bridge as once."""
    log = _actor_credits(spark, sf_dir)
    replayed = log.unionByName(log)
    bridges = model.build_bridges(clean.clean_credit_items(replayed))
    return model.bridge(bridges, ACTOR).select("movie_key", "entity_key")


def width_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 (with C2/C3 before it): conversation texts as cast names; names
    over 100 characters are rejected, junk-only ones dropped."""
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    items = _credits(conv, item_seq(F.col("conv_id"), 0, F.col("turn")),
                     F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")), ACTOR, F.col("text"))
    turn = (F.col("seq") % F.lit(10 ** 10)).cast("bigint")
    conv_id = ((F.col("seq") - turn) / F.lit(10 ** 11)).cast("bigint")
    return clean.clean_credit_items(items).select(conv_id.alias("conv_id"), turn.alias("turn"), "reason")


def film_latest_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two film items per order under two spellings of its title. The
    first spelling names the film, the second item's facts replace the
    first's, also where they are null."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    key, title = F.col("o_orderkey"), _title(F.col("o_orderkey"))
    price = F.col("o_totalprice").cast("decimal(12,2)")
    million = F.lit(" million")

    def items(pos: int, film, amount, date):
        return o.select(item_seq(key, 0, pos).alias("seq"), F.lit(None).cast("bigint").alias("page_id"), film.alias("film"),
                        F.lit(None).cast("string").alias("budget"), amount.alias("box_office"), date.alias("release_date"))

    early = items(0, F.upper(title), F.concat(F.lit("$"), (price + 1).cast("string"), million), F.lit("1999"))
    late = items(1, F.concat(title, F.lit(" ")),
                 F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("$"), price.cast("string"), million)),
                 F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd"))
    films = clean.clean_film_items(late.unionByName(early))
    none = clean.clean_credit_items(_credits(o.where("false"), item_seq(key, 0, 2), title, ACTOR, title))
    return model.build_movies(films, none).select("movie", "box_office", "release_date")


def star_cast_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cast as names, through the ids of the built tables."""
    tables = star.tables_of(star.build_star(*driver_items(spark, sf_dir), materialize_cleaned=True))
    return (tables["castlist"].join(tables["movies"], "movie_id").join(tables["actors"], "actor_id").select("movie", "actor"))


def star_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L12 on the built star: UNIQUE, FOREIGN KEY and id-collision checks."""
    return star.check_star(star.stored(star.build_star(*driver_items(spark, sf_dir), materialize_cleaned=True)))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L12 UNIQUE check: part names used by more than one part."""
    return model.dq_duplicates(table(spark, sf_dir, "part", "p_name"), "p_name")


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L12 FOREIGN KEY checks (anti joins), plus films without credits."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_partkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    checks = [
        ("lineitem.l_orderkey -> orders", li.select(F.col("l_orderkey").alias("k")), o.select(F.col("o_orderkey").alias("k"))),
        ("lineitem.l_suppkey -> supplier", li.select(F.col("l_suppkey").alias("k")),
         table(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("k"))),
        ("lineitem.l_partkey -> part", li.select(F.col("l_partkey").alias("k")),
         table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").alias("k"))),
        ("orders.o_custkey -> customer", o.select(F.col("o_custkey").alias("k")),
         table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("k"))),
        ("orders without lineitem", o.select(F.col("o_orderkey").alias("k")), li.select(F.col("l_orderkey").alias("k"))),
    ]
    parts = [model.dq_orphans(child, parent, "k").agg(F.count("*").alias("n_orphans"))
             .select(F.lit(name).alias("check"), "n_orphans") for name, child, parent in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


REGISTRY = {
    "item_fanout": item_fanout,
    "canonical_names": canonical_names,
    "dim_first_spelling": dim_first_spelling,
    "latest_wins": latest_wins,
    "stub_facts": stub_facts,
    "replay_idempotent": replay_idempotent,
    "width_rejects": width_rejects,
    "film_latest_facts": film_latest_facts,
    "star_cast_by_id": star_cast_by_id,
    "star_checks": star_checks,
    "dq_duplicates": dq_duplicates,
    "dq_orphans": dq_orphans,
}

ORACLES = {
    "item_fanout": f"""
WITH {ITEM_LINES}
SELECT 'movie' AS kind, COUNT(*) AS n_items, COUNT(DISTINCT o_orderkey) AS n_films FROM orders
UNION ALL
SELECT 'director', COUNT(*), COUNT(DISTINCT o.o_orderkey) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL SELECT 'actor', COUNT(*), COUNT(DISTINCT l_orderkey) FROM lines
UNION ALL SELECT 'distributor', COUNT(*), COUNT(DISTINCT l_orderkey) FROM lines
UNION ALL SELECT 'prod_co', COUNT(*), COUNT(DISTINCT l_orderkey) FROM lines""",
    "canonical_names": r"""
WITH words AS (SELECT unnest(regexp_split_to_array(text, '[^\pL]+')) AS w FROM documents)
SELECT lower(strip_accents(rtrim(w))) AS name_key, COUNT(*) AS n_words, COUNT(DISTINCT w) AS n_spellings
FROM words WHERE w <> '' GROUP BY 1""",
    "dim_first_spelling": """
SELECT lower(p_name) AS entity_key, arg_min(CASE
    WHEN p_size <= 12 THEN upper(p_name)
    WHEN p_size <= 25 THEN p_name || '   '
    WHEN p_size <= 37 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2)
    ELSE p_name END, p_partkey) AS entity
FROM part GROUP BY 1""",
    "latest_wins": """
SELECT user_id, event_type, value, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "stub_facts": """
SELECT 'Order ' || CAST(o_orderkey AS VARCHAR) AS movie,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(12,6)) END AS box_office,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS release_date
FROM orders o
WHERE o_orderpriority <> '5-LOW' OR EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "replay_idempotent": """
SELECT DISTINCT 'order ' || CAST(l.l_orderkey AS VARCHAR) AS movie_key, lower(s.s_name) AS entity_key
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    # Conversation texts are prose: none is junk unless it is blank of letters; names start after commas and slashes.
    "width_rejects": """
SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE
    WHEN text IS NULL OR NOT regexp_matches(text, '[\\pL\\pN]') THEN 'name_junk'
    WHEN length(ltrim(text, ',/')) > 100 THEN 'name_too_long'
    END AS reason
FROM conversations""",
    "film_latest_facts": """
SELECT 'ORDER ' || CAST(o_orderkey AS VARCHAR) AS movie,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,6)) END AS box_office,
       CAST(o_orderdate AS DATE) AS release_date
FROM orders""",
    "star_cast_by_id": """
WITH credited AS (
  SELECT l.l_orderkey AS film, l.l_suppkey AS person FROM lineitem l GROUP BY 1, 2),
spelled AS (  -- the first line that credits a person spells the name
  SELECT l_suppkey AS person, arg_min(l_linenumber, l_orderkey * 100 + l_linenumber) AS line FROM lineitem GROUP BY 1)
SELECT 'Order ' || CAST(film AS VARCHAR) AS movie,
       CASE line WHEN 2 THEN upper(s_name) WHEN 3 THEN s_name || '  ' WHEN 4 THEN lower(s_name) ELSE s_name END AS actor
FROM credited JOIN spelled USING (person) JOIN supplier ON s_suppkey = person JOIN orders ON o_orderkey = film""",
    "star_checks": """
SELECT unnest(['movies.movie_id unique', 'movies.movie unique', 'movies.movie_id collisions',
  'actors.actor_id unique', 'actors.actor unique', 'castlist pairs unique', 'castlist -> movies', 'castlist -> actors',
  'directors.director_id unique', 'directors.director unique', 'filmdirectors pairs unique', 'filmdirectors -> movies',
  'filmdirectors -> directors', 'distributors.distributor_id unique', 'distributors.distributor unique',
  'filmdistributors pairs unique', 'filmdistributors -> movies', 'filmdistributors -> distributors',
  'productionco.prod_co_id unique', 'productionco.prod_co unique', 'filmprodco pairs unique', 'filmprodco -> movies',
  'filmprodco -> productionco', 'entity_id collisions']) AS "check", CAST(0 AS BIGINT) AS n_bad""",
    "dq_duplicates": "SELECT p_name, COUNT(*) AS n FROM part GROUP BY p_name HAVING COUNT(*) > 1",
    "dq_orphans": """
SELECT 'lineitem.l_orderkey -> orders' AS "check", COUNT(*) AS n_orphans FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem.l_suppkey -> supplier', COUNT(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL SELECT 'lineitem.l_partkey -> part', COUNT(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'orders.o_custkey -> customer', COUNT(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'orders without lineitem', COUNT(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
}
