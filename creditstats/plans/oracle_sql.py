"""DuckDB SQL oracles for the registered queries (views over the driver
tables: region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations).

Averages: DuckDB's avg() and decimal division return DOUBLE, which can
round an exact half differently. The oracle therefore computes the mean
in integers, rounding half-up to 10 decimals and then to 6, which is what
a decimal AVG followed by CAST(... AS DECIMAL(12,6)) does.
"""

from __future__ import annotations


def avg6(col: str) -> str:
    micro = f"SUM(CAST(ROUND({col} * 1000000) AS HUGEINT))"
    n = f"CAST(COUNT({col}) AS HUGEINT)"
    q10 = f"((2 * {micro} * 10000 + {n}) // (2 * {n}))"
    q6 = f"((2 * {q10} + 10000) // 20000)"
    return f"CAST(CAST({q6} AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6))"


def std6(col: str) -> str:
    """Population stddev from exact integer moments (millionths), square
    root in double, then CAST(... AS DECIMAL(12,6)); 0 when it is 0."""
    m = f"CAST(ROUND({col} * 1000000) AS HUGEINT)"
    n = f"CAST(COUNT({col}) AS HUGEINT)"
    var_n2 = f"({n} * SUM({m} * {m}) - SUM({m}) * SUM({m}))"
    std = f"(SQRT(CAST({var_n2} AS DOUBLE)) / CAST(COUNT({col}) AS DOUBLE) / 1e6)"
    return (f"CASE WHEN {std} <> 0 THEN CAST({std} AS DECIMAL(12,6)) "
            f"ELSE CAST(0 AS DECIMAL(12,6)) END")


FILMS = """films AS (
  SELECT o_orderkey AS movie_id, CAST(o_orderkey AS VARCHAR) AS movie,
         CAST(o_totalprice AS DECIMAL(12,6)) AS box_office, CAST(o_orderdate AS DATE) AS release_date
  FROM orders)"""

SUPPLIER_BRIDGE = """bridge AS (SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS entity_id FROM lineitem)"""


def _stats_sql(name: str) -> str:
    """A report per entity over pairs(name, box_office, movie) of credited films."""
    return f"""
SELECT {name}, MAX(box_office) AS box_office_max, MIN(box_office) AS box_office_min, {avg6('box_office')} AS box_office_avg,
       {std6('box_office')} AS box_office_std, COUNT(movie) AS film_count
FROM pairs GROUP BY {name}"""


def _entity_stats_sql() -> str:
    return f"""
WITH {FILMS}, {SUPPLIER_BRIDGE},
pairs AS (
  SELECT s_name AS entity, box_office, movie
  FROM bridge JOIN films USING (movie_id) JOIN supplier ON s_suppkey = entity_id
  WHERE box_office IS NOT NULL)
{_stats_sql('entity')}"""


def _rollup_stats(name: str, all_label: str) -> str:
    """Per entity and year, per entity and in all, over
    pairs(name, release_year, box_office, movie)."""
    parts = []
    for entity, year in ((name, "CAST(release_year AS VARCHAR)"), (name, "'All years'"), (f"'{all_label}'", "'All years'")):
        parts.append(f"""
SELECT {entity} AS {name}, {year} AS release_year, MAX(box_office) AS box_office_max, MIN(box_office) AS box_office_min,
       COUNT(movie) AS film_count, {avg6('box_office')} AS box_office_avg, {std6('box_office')} AS box_office_std
FROM pairs""")
    return f"{parts[0]} GROUP BY {name}, pairs.release_year UNION ALL {parts[1]} GROUP BY {name} UNION ALL {parts[2]}"


def _rollup_sql(named_pairs: str, all_label: str) -> str:
    return f"""
WITH {FILMS}, credited AS ({named_pairs}),
pairs AS (
  SELECT entity, year(release_date) AS release_year, box_office, movie
  FROM credited JOIN films USING (movie_id) WHERE box_office IS NOT NULL)
{_rollup_stats('entity', all_label)}"""


# Items rendered from the driver tables (plans.driver_items), stated by
# their known clean values: box office = o_totalprice unless the order is
# pending; release date = o_orderdate, first of the month for the
# 'Month yyyy' style (Thursdays).
ITEM_FILMS = """films AS (
  SELECT o_orderkey AS movie_id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS movie,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,6)) END AS box_office,
         CASE WHEN dayofweek(o_orderdate) = 4 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
              ELSE CAST(o_orderdate AS DATE) END AS release_date
  FROM orders)"""

ITEM_LINES = """lines AS (
  SELECT l.l_orderkey, l.l_linenumber, s.s_name, n.n_name, p.p_name, p.p_size
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def _varied(col: str) -> str:
    return (f"CASE l_linenumber WHEN 2 THEN upper({col}) WHEN 3 THEN {col} || '  ' "
            f"WHEN 4 THEN lower({col}) ELSE {col} END")


def _item_credits(kind: str) -> str:
    if kind == "actor":
        return (f"SELECT l_orderkey AS movie_id, lower(s_name) AS k, l_orderkey * 1000 + l_linenumber * 10 + 1 AS seq, "
                f"{_varied('s_name')} AS v FROM lines")
    if kind == "director":
        return ("SELECT o.o_orderkey AS movie_id, lower(c.c_name) AS k, o.o_orderkey * 1000 + 2 AS seq, "
                "CASE WHEN o.o_orderstatus = 'O' THEN upper(c.c_name) ELSE c.c_name END AS v "
                "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
    if kind == "distributor":
        return (f"SELECT l_orderkey AS movie_id, lower(n_name) AS k, l_orderkey * 1000 + l_linenumber * 10 + 3 AS seq, "
                f"{_varied('n_name')} AS v FROM lines")
    return ("SELECT l_orderkey AS movie_id, CASE WHEN p_size <= 6 THEN ' ' || p_name ELSE p_name END AS k, "
            "l_orderkey * 1000 + l_linenumber * 10 + 4 AS seq, "
            "CASE WHEN p_size <= 6 THEN ' ' || p_name ELSE p_name END AS v FROM lines WHERE p_size > 3")


def _item_pairs(kind: str, name: str) -> str:
    """pairs(name, release_year, box_office, movie) of the rendered items,
    entities under their first spelling."""
    return f"""
WITH {ITEM_FILMS}, {ITEM_LINES},
credits AS ({_item_credits(kind)}),
names AS (SELECT k, arg_min(v, seq) AS {name} FROM credits GROUP BY k),
pairs AS (
  SELECT {name}, year(release_date) AS release_year, box_office, movie
  FROM (SELECT DISTINCT movie_id, k FROM credits) JOIN films USING (movie_id) JOIN names USING (k)
  WHERE box_office IS NOT NULL)"""


def _item_report(kind: str, name: str) -> str:
    return _item_pairs(kind, name) + _stats_sql(name)


def _item_rollup(kind: str, name: str, label: str) -> str:
    return _item_pairs(kind, name) + _rollup_stats(name, label)


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["film_actor_report"] = _item_report("actor", "actor")
    q["film_director_report"] = _item_report("director", "director")
    q["film_distributor_rollup"] = _item_rollup("distributor", "distributor", "All distributors")
    q["film_prodco_rollup"] = _item_rollup("prod_co", "prod_co", "All production companies")
    q["entity_stats"] = _entity_stats_sql()
    q["entity_stats_sorted"] = f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY box_office_max DESC, box_office_avg DESC, film_count DESC, entity ASC) AS rank
FROM ({_entity_stats_sql()}) t"""
    q["entity_stats_by_part_name"] = f"""
WITH {FILMS},
pairs AS (
  SELECT entity, box_office, movie
  FROM (SELECT DISTINCT l_orderkey AS movie_id, p_name AS entity FROM lineitem JOIN part ON l_partkey = p_partkey)
  JOIN films USING (movie_id) WHERE box_office IS NOT NULL)
{_stats_sql('entity')}"""
    q["entity_year_rollup"] = _rollup_sql(
        "SELECT DISTINCT l_orderkey AS movie_id, s_name AS entity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
        "All distributors")
    q["nation_year_rollup"] = _rollup_sql(
        "SELECT DISTINCT l_orderkey AS movie_id, n_name AS entity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
        "JOIN nation ON s_nationkey = n_nationkey", "All production companies")
    q["left_join_keep_all"] = """
SELECT o.o_orderkey AS movie_id, COUNT(l.l_orderkey) AS n_credits
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey"""
    q["join_notnull_inner"] = f"""
WITH {FILMS}, {SUPPLIER_BRIDGE}
SELECT s.s_name AS entity, m.movie_id, m.box_office
FROM supplier s JOIN bridge b ON s.s_suppkey = b.entity_id JOIN films m ON b.movie_id = m.movie_id
WHERE m.box_office IS NOT NULL"""
    q["year_extract"] = """
SELECT CAST(YEAR(o_orderdate) AS BIGINT) AS release_year, COUNT(*) AS n_films FROM orders GROUP BY 1"""
    q["report_headers"] = f"""
SELECT entity AS "actor", box_office_max AS "box office max (in millions)",
       box_office_min AS "box office min (in millions)", box_office_avg AS "box office avg (in millions)",
       box_office_std AS "box office std (in millions)", film_count AS "film count"
FROM ({_entity_stats_sql()}) t"""
    q["bridge_distinct"] = "SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS entity_id FROM lineitem"
    return q
