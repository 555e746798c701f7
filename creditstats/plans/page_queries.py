"""Registered queries for page extraction (X1-X5, X9) over the driver's
`pages` table: every page, whole HTML. The driver pages are generic (a
heading, a navigation list, paragraphs; no infobox), so titles fall back to
the h1 and <title> rules and links and list values come from the
navigation list. The film infobox and list-page rules are exercised by
the synthetic pages in tests/test_pages.py.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..session import ensure_checkpoint_dir
from ..sources import pages as P
from ..sources.tables import table


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and number from the URL, and the number-range test
    (the reference keeps list pages of the years 2003..2022)."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    scanned = P.page_scan(pages, 0, 499, P.URL_NUMBER)
    return scanned.select("page_id", F.regexp_extract("url", P.URL_LANG, 1).alias("lang"), "url_number", "in_scope")


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages under film-list URLs of the years 1990 to 2039 (by page
    number; one in eleven is no list page), laid out by year; the lists of
    2003 to 2022 are read."""
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    number = F.col("page_id") % 50 + 1990
    url = F.when(F.col("page_id") % 11 != 0, F.concat(F.lit("https://en.wikipedia.org/wiki/List_of_American_films_of_"), number.cast("string"))).otherwise(
        F.lit("https://en.wikipedia.org/wiki/Film"))
    path = os.path.join(ensure_checkpoint_dir(spark), f"pages-by-year-{uuid.uuid4().hex}")
    P.write_pages_by_year(pages.withColumn("url", url), path)
    kept = P.list_pages(spark.read.parquet(path))
    return kept.select("page_id", F.col("list_year").cast("long").alias("list_year"), F.length("html").cast("long").alias("html_chars"))


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first title rule that finds a text node."""
    ex = _extracted(spark, sf_dir)
    return ex.select("page_id", P.first_match(F.col("title_rules"), 4).alias("title"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per list entry, its first link resolved against the page URL."""
    return P.list_links(_extracted(spark, sf_dir), "nav_links").select("page_id", "ord", "href")


def page_links_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links present, not the page itself, each once."""
    return P.distinct_links(P.list_links(_extracted(spark, sf_dir), "nav_links"))


def page_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List values (link texts, then bare entry texts), stripped,
    empty ones dropped."""
    ex = _extracted(spark, sf_dir)
    items = ex.select("page_id", F.posexplode("nav_items").alias("pos", "raw"))
    return (items.select("page_id", "pos", text.strip_ws(F.col("raw")).alias("value"))
            .where(text.nonempty(F.col("value"))))


REGISTRY = {
    "page_scan": page_scan,
    "list_pages": list_pages,
    "page_title": page_title,
    "page_links": page_links,
    "page_links_distinct": page_links_distinct,
    "page_list_items": page_list_items,
}


def _decode(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


_LINKS = f"""links AS (
  SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages),
rows AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS ord,
         regexp_extract(url, '^([a-z]+://[^/]+)', 1) || {_decode('hrefs[i]')} AS href, url
  FROM links, range(1, len(hrefs) + 1) AS g(i))"""

ORACLES = {
    "list_pages": """
SELECT page_id, 1990 + page_id % 50 AS list_year, CAST(length(html) AS BIGINT) AS html_chars
FROM pages WHERE page_id % 11 <> 0 AND 1990 + page_id % 50 BETWEEN 2003 AND 2022""",
    "page_scan": r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) AS lang,
       CAST(NULLIF(regexp_extract(url, '/(\d+)(?:[/?#.]|$)', 1), '') AS INTEGER) AS url_number,
       CAST(NULLIF(regexp_extract(url, '/(\d+)(?:[/?#.]|$)', 1), '') AS INTEGER) BETWEEN 0 AND 499 AS in_scope
FROM pages""",
    "page_title": f"""
SELECT page_id, CASE WHEN regexp_extract(html, '<h1[^>]*>([^<]+)', 1) <> ''
    THEN {_decode("regexp_extract(html, '<h1[^>]*>([^<]+)', 1)")}
    ELSE {_decode("regexp_extract(html, '<title>([^<]+)', 1)")} END AS title
FROM pages""",
    "page_links": f"WITH {_LINKS} SELECT page_id, ord, href FROM rows",
    "page_links_distinct": f"WITH {_LINKS} SELECT DISTINCT href FROM rows WHERE href <> url",
    "page_list_items": f"""
WITH items AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS vals FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_decode('vals[i]')} AS value
FROM items, range(1, len(vals) + 1) AS g(i)
WHERE vals[i] <> ''""",
}
