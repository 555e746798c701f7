"""Page extraction (X1-X12): one distributed mapInArrow job over the page
table, then DataFrame code.

The Python side only looks things up in one page's tree and returns raw
candidates; choosing among candidates (first match, first valid date),
stripping, exploding, de-duplicating and URL filtering are Spark
expressions over its output. Each task parses the pages of its own
partition; no page or result passes through the driver.

Rule tables are fixed values of the reference (infobox row headers, the
quarter headings of list pages, the date-candidate checks).
"""

from __future__ import annotations

from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schema import ACTOR, DIRECTOR, DISTRIBUTOR, PROD_CO, item_seq
from ..session import ship
from .html_tree import Node, parse, release

# ---------------------------------------------------------------------------
# The reference's lookup rules.
# List pages: films of 2003..2022 inclusive, under the quarter headings
# January, April, July and October (matched on the heading's second span).
YEARS = (2003, 2022)
QUARTERS = ("January", "April", "July", "October")
# Infobox rows (header text contains ...):
BUDGET_HEADER = "Budget"
BOX_OFFICE_HEADER = "Box office"
BOX_OFFICE_TOTAL = "total"
DATE_HEADER_WORDS = ("date", "elease")
US_WORDS = ("States", "US")
# Credit rows: kind -> header text; production companies sit one div deeper.
CREDIT_HEADERS = ((ACTOR, "Starring"), (DIRECTOR, "Directed by"), (DISTRIBUTOR, "Distributed"),
                  (PROD_CO, "Production"))
# ---------------------------------------------------------------------------

CREDIT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("pos", T.IntegerType()),
                       T.StructField("value", T.StringType())])
LINK = T.StructType([T.StructField("ord", T.IntegerType()), T.StructField("href", T.StringType())])

EXTRACTED = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    # title rules: h1#firstHeading/i, h1#firstHeading/span, then (for generic
    # pages) the first h1 text and the <title> text
    T.StructField("title_rules", T.ArrayType(T.StringType())),
    T.StructField("budget_rules", T.ArrayType(T.StringType())),
    T.StructField("box_office_rules", T.ArrayType(T.StringType())),
    T.StructField("date_candidates", T.ArrayType(T.StringType())),
    T.StructField("credits", T.ArrayType(CREDIT)),
    T.StructField("list_links", T.ArrayType(LINK)),
    T.StructField("nav_links", T.ArrayType(LINK)),
    T.StructField("nav_items", T.ArrayType(T.StringType())),
])


# --- lookups on one page ------------------------------------------------------

def _first(xs):
    for x in xs:
        return x
    return None


def _header_rows(root: Node, word: str, via_div: bool = False) -> list[Node]:
    """tr elements whose first th (or, via_div, first th/div) contains word."""
    out = []
    for tr in root.descendants("tr"):
        ths = tr.elements("th")
        if via_div:
            heads = [d for th in ths for d in th.elements("div")]
        else:
            heads = ths
        if heads and word in heads[0].string():
            out.append(tr)
    return out


def _tds(rows: list[Node]) -> list[Node]:
    return [td for tr in rows for td in tr.elements("td")]


def _texts_of(nodes) -> list[str]:
    return [t for n in nodes for t in n.texts()]


def _money_rules(root: Node, header: str, total: bool) -> list[str | None]:
    tds = _tds(_header_rows(root, header))
    spans = [s for td in tds for s in td.elements("span")]
    first_lis = [li for td in tds for li in td.descendants("li") if li.is_first_of_type()]
    rules = [_first(_texts_of(tds)), _first(_texts_of(spans))]
    if total:
        total_lis = [li for td in tds for li in td.descendants("li") if BOX_OFFICE_TOTAL in li.string()]
        rules.append(_first(_texts_of(total_lis)))
    rules.append(_first(_texts_of(first_lis)))
    return rules


def _date_candidates(root: Node) -> list[str | None]:
    rows = []
    for tr in root.descendants("tr"):
        ths = tr.elements("th")
        if ths and any(w in ths[0].string() for w in DATE_HEADER_WORDS):
            rows.extend(tr.elements("td"))
    if not rows:
        return [None] * 4
    td = rows[0]

    def span_span_text(nodes):
        return _first(_texts_of([s2 for n in nodes for s1 in n.elements("span") for s2 in s1.elements("span")]))

    lis = td.descendants("li")
    us = [li for li in lis if any(any(w in t for w in US_WORDS) for t in li.texts())]
    return [
        span_span_text(us),
        span_span_text([li for li in lis if li.is_first_of_type()]),
        span_span_text([td]),
        _first(td.texts()),
    ]


def _list_or_inline(first: list[Node], second: list[Node]) -> list[str]:
    """All link texts then all bare texts of the list entries when a
    list with direct entries exists, else the cell's own links then texts.
    Raw text nodes; stripping and the empty filter happen in Spark."""
    if first and any(ul.elements("li") for ul in first):
        lis = [[li for li in ul.descendants("li")] for ul in first]
        links = [t for group in lis for li in group for a in li.elements("a") for t in a.texts()]
        bare = [t for group in lis for li in group for t in li.texts()]
        return links + bare
    links = [t for cell in second for a in cell.elements("a") for t in a.texts()]
    bare = [t for cell in second for t in cell.texts()]
    return links + bare


def _credits(root: Node) -> list[dict]:
    out = []
    for kind, header in CREDIT_HEADERS:
        if kind == PROD_CO:
            rows = _header_rows(root, header, via_div=True)
            cells = [d for td in _tds(rows) for d in td.elements("div")]
            first = [ul for d in cells for d2 in d.elements("div") for ul in d2.elements("ul")]
        else:
            rows = _header_rows(root, header)
            cells = _tds(rows)
            first = [ul for td in cells for d in td.elements("div") for ul in d.elements("ul")]
        for i, v in enumerate(_list_or_inline(first, cells)):
            out.append({"kind": kind, "pos": i, "value": v})
    return out


def _list_links(root: Node, url: str) -> list[dict]:
    """Per quarter heading, the rows of the first following table; each
    row's first italic link, resolved (a row without one resolves to the
    list page itself, as urljoin does)."""
    out, n = [], 0
    for month in QUARTERS:
        for h2 in root.descendants("h2"):
            spans = h2.elements("span")
            if h2.parent is None or h2.parent.tag != "div" or len(spans) < 2 or month not in spans[1].string():
                continue
            table = _first(s for s in h2.following_siblings() if s.tag == "table")
            if table is None:
                continue
            for tbody in table.elements("tbody"):
                for tr in tbody.elements("tr"):
                    href = _first(a.attrs.get("href") for td in tr.elements("td")
                                  for i in td.elements("i") for a in i.elements("a") if "href" in a.attrs)
                    out.append({"ord": n, "href": urljoin(url or "", href) if href else (url or None)})
                    n += 1
    return out


def _nav(root: Node, url: str) -> tuple[list[dict], list[str]]:
    """Generic pages: the navigation list as rows (first link of each entry,
    resolved) and as X9 list values."""
    uls = [ul for nav in root.descendants("nav") for ul in nav.elements("ul")]
    links, n = [], 0
    for ul in uls:
        for li in ul.elements("li"):
            href = _first(a.attrs["href"] for a in li.elements("a") if "href" in a.attrs)
            links.append({"ord": n, "href": urljoin(url or "", href) if href else None})
            n += 1
    return links, _list_or_inline(uls, root.descendants("nav"))


def extract_page(page_id: int, url: str | None, html: str | None) -> dict:
    root = parse(html)
    try:
        return _lookups(root, page_id, url)
    finally:
        release(root)


def _lookups(root: Node, page_id: int, url: str | None) -> dict:
    headings = [h for h in root.descendants("h1") if h.attrs.get("id") == "firstHeading"]
    h1 = root.descendants("h1")
    title = root.descendants("title")
    nav_links, nav_items = _nav(root, url)
    return {
        "page_id": page_id,
        "url": url,
        "title_rules": [
            _first(_texts_of([i for h in headings for i in h.elements("i")])),
            _first(_texts_of([s for h in headings for s in h.elements("span")])),
            _first(_texts_of(h1)),
            _first(_texts_of(title)),
        ],
        "budget_rules": _money_rules(root, BUDGET_HEADER, total=False),
        "box_office_rules": _money_rules(root, BOX_OFFICE_HEADER, total=True),
        "date_candidates": _date_candidates(root),
        "credits": _credits(root),
        "list_links": _list_links(root, url),
        "nav_links": nav_links,
        "nav_items": nav_items,
    }


_ARROW_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()),
    ("title_rules", pa.list_(pa.string())), ("budget_rules", pa.list_(pa.string())),
    ("box_office_rules", pa.list_(pa.string())), ("date_candidates", pa.list_(pa.string())),
    ("credits", pa.list_(pa.struct([("kind", pa.string()), ("pos", pa.int32()), ("value", pa.string())]))),
    ("list_links", pa.list_(pa.struct([("ord", pa.int32()), ("href", pa.string())]))),
    ("nav_links", pa.list_(pa.struct([("ord", pa.int32()), ("href", pa.string())]))),
    ("nav_items", pa.list_(pa.string())),
])


PAGES_AT_ONCE = 64  # pages whose text and candidates are held as Python values


def _extract_batches(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            part = batch.slice(at, PAGES_AT_ONCE)
            rows = [extract_page(*(part.column(c)[i].as_py() for c in ("page_id", "url", "html"))) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> one row of raw candidates per page
    (schema EXTRACTED). Narrow: runs inside each partition of `pages`."""
    ship(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extract_batches, EXTRACTED)


# --- DataFrame side -----------------------------------------------------------

URL_NUMBER = r"/(\d+)(?:[/?#.]|$)"
URL_LANG = r"^[a-z]+://[^/]+/([a-z]{2})/"
LIST_YEAR = r"List_of_American_films_of_(\d{4})"


def page_scan(pages: DataFrame, lo: int, hi: int, pattern: str = LIST_YEAR) -> DataFrame:
    """The number in each page's URL (the list year for film list
    pages) and whether it is in [lo, hi]. Column-pruned: html is not read."""
    num = F.regexp_extract("url", pattern, 1)
    n = F.when(num != "", num.cast("int"))
    return pages.select("page_id", "url", n.alias("url_number"),
                        (n.between(lo, hi)).alias("in_scope"))


# Fixed value: the years whose film lists are read.
LIST_YEARS = (2003, 2022)


def write_pages_by_year(pages: DataFrame, path: str, pattern: str = LIST_YEAR) -> None:
    """Lay pages out by the list year in their URL (list_year; pages that are
    no film list have none), so that a read of some years reads their folders
    alone. A year's pages may be many: Spark cuts them into several files."""
    year = F.regexp_extract("url", pattern, 1)
    tagged = pages.withColumn("list_year", F.when(year != "", year.cast("int")))
    tagged.hint("rebalance", "list_year").write.partitionBy("list_year").parquet(path)


def list_pages(pages: DataFrame, years: tuple[int, int] = LIST_YEARS, pattern: str = LIST_YEAR) -> DataFrame:
    """The film list pages of the years, with list_year. On pages laid out
    by `write_pages_by_year` the predicate prunes folders; on others it is a
    filter on the URL, so html is read of the kept rows' row groups only."""
    if "list_year" not in pages.columns:
        year = F.regexp_extract("url", pattern, 1)
        pages = pages.withColumn("list_year", F.when(year != "", year.cast("int")))
    return pages.where(F.col("list_year").between(*years))


def first_match(rules: Column, n: int) -> Column:
    """The first rule that found anything."""
    return F.coalesce(*[rules[i] for i in range(n)])


def release_date_choice(c: Column) -> Column:
    """The first date candidate its own check does not reject: the US
    entry unless it reads exactly 'United States' without parentheses; the
    others unless shorter than 4 characters. Empty text is absent."""
    def ok(x, rejected):
        return F.when(text.nonempty(x) & ~rejected, x)
    us = c[0]
    return F.coalesce(
        ok(us, F.regexp_replace(us, r"\(|\)", "") == "United States"),
        *[ok(c[i], F.char_length(c[i]) < 4) for i in (1, 2, 3)],
    )


def film_items(extracted: DataFrame) -> DataFrame:
    """X12 film part: one film item per page (schema.FILM_ITEMS). The film
    title uses the reference's two title rules only."""
    return extracted.select(
        item_seq(F.col("page_id"), 0, 0).alias("seq"),
        "page_id",
        first_match(F.col("title_rules"), 2).alias("film"),
        first_match(F.col("budget_rules"), 3).alias("budget"),
        first_match(F.col("box_office_rules"), 4).alias("box_office"),
        release_date_choice(F.col("date_candidates")).alias("release_date"),
    )


def credit_items(extracted: DataFrame) -> DataFrame:
    """X9-X12 credit part: one item per stripped, non-empty value
    (schema.CREDIT_ITEMS), tagged with the page's film title."""
    exploded = extracted.select(
        "page_id", first_match(F.col("title_rules"), 2).alias("film"), F.explode("credits").alias("c"))
    v = text.strip_ws(F.col("c.value"))
    kind_index = F.array_position(F.array(*[F.lit(k) for k, _ in CREDIT_HEADERS]), F.col("kind"))
    return (
        exploded.select("page_id", "film", F.col("c.kind").alias("kind"), F.col("c.pos").alias("pos"),
                        v.alias("value"))
        .where(text.nonempty(F.col("value")))
        .select(item_seq(F.col("page_id"), kind_index, F.col("pos")).alias("seq"), "page_id", "film", "kind", "value")
    )


def list_links(extracted: DataFrame, column: str = "list_links") -> DataFrame:
    """(page_id, url, ord, href) per list row, href resolved."""
    return extracted.select("page_id", "url", F.explode(column).alias("l")).select(
        "page_id", "url", F.col("l.ord").alias("ord"), F.col("l.href").alias("href"))


def distinct_links(links: DataFrame) -> DataFrame:
    """A row without a link resolves to its own list page, which was
    already requested, so it is dropped with the null links; then each
    linked URL once (the crawler requests a film linked twice once)."""
    out = links.where(F.col("href").isNotNull() & (F.col("href") != F.coalesce(F.col("url"), F.lit(""))))
    return out.select("href").distinct()
