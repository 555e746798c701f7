"""X2-X12 on hand-written pages, one per branch of the reference's rules
(FIXTURES §4), and the whole flow from pages to reports."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from creditstats.plans import star as S
from creditstats.sources import pages as P

FILM_A = """<html><body>
<h1 id="firstHeading"><i>Alpha Film</i></h1>
<table class="infobox"><tbody>
<tr><th>Directed by</th><td><a href="/d1">Dana Director</a></td></tr>
<tr><th>Starring</th><td><div><ul><li><a href="/a1">Ann Actor</a></li><li>Bob Bare</li>
  <li><a href="/a2">Beyoncé</a> (voice)</li></ul></div></td></tr>
<tr><th><div>Production<br>companies</div></th><td><div><div><ul><li>Studio One</li><li>, Studio Two</li></ul></div></div></td></tr>
<tr><th>Distributed by</th><td><a href="/x">Dist Co</a> (US)<br>Other Dist</td></tr>
<tr><th>Release date</th><td><div><ul><li>March 4, 2005<span><span>(Cannes)</span></span></li>
  <li>United States<span><span>March 4, 2005</span></span></li></ul></div></td></tr>
<tr><th>Budget</th><td>$150 million</td></tr>
<tr><th>Box office</th><td><div><ul><li>$1.2 billion</li><li>$300 million total</li></ul></div></td></tr>
</tbody></table></body></html>"""

# title in a span; money in spans; date as plain cell text; credits inline
FILM_B = """<html><body>
<h1 id="firstHeading"><span>Beta Film</span></h1>
<table><tbody>
<tr><th>Directed by</th><td>Dana Director<br><a href="/e">Eve Else</a></td></tr>
<tr><th>Starring</th><td><a href="/a">BEYONCE</a><br>Carl Cast</td></tr>
<tr><th>Budget</th><td><span>$20 million</span></td></tr>
<tr><th>Box office</th><td><span>$100–120 million</span></td></tr>
<tr><th>Release dates</th><td>2006-07-08</td></tr>
</tbody></table></body></html>"""

# a US entry that is rejected ("(United States)"), then too-short
# candidates, then the cell's own text
FILM_C = """<html><body>
<h1 id="firstHeading"><i>Gamma Film</i></h1>
<table><tbody>
<tr><th>Starring</th><td><div><ul></ul></div>beyonce </td></tr>
<tr><th>Box office</th><td>$45,000</td></tr>
<tr><th>Release</th><td>May 2007<ul><li>TBA<span><span>TBA</span></span></li>
  <li>US<span><span>(United States)</span></span></li></ul></td></tr>
</tbody></table></body></html>"""

LIST_PAGE = """<html><body><div>
<h2><span>x</span><span>January–March</span></h2>
<table><tbody><tr><td><i><a href="/wiki/Alpha">Alpha</a></i></td></tr>
<tr><td>no link here</td></tr>
<tr><td><i><a href="/wiki/Beta">Beta</a></i></td></tr></tbody></table>
<h2><span>x</span><span>April–June</span></h2>
<table><tbody><tr><td><i><a href="/wiki/Alpha">Alpha again</a></i></td></tr></tbody></table>
<h2><span>x</span><span>Summer</span></h2>
<table><tbody><tr><td><i><a href="/wiki/Zeta">Zeta</a></i></td></tr></tbody></table>
</div></body></html>"""

LIST_URL = "https://films.example.org/wiki/List_of_American_films_of_2005"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(1, "https://films.example.org/wiki/Alpha", FILM_A), (2, "https://films.example.org/wiki/Beta", FILM_B),
         (3, "https://films.example.org/wiki/Gamma", FILM_C), (4, LIST_URL, LIST_PAGE)],
        "page_id long, url string, html string")


def test_film_items(spark, pages):
    films = {r.page_id: r for r in P.film_items(P.extract(pages)).collect()}
    assert (films[1].film, films[1].budget, films[1].box_office) == ("Alpha Film", "$150 million", "$300 million total")
    assert films[1].release_date == "March 4, 2005"  # the US entry's nested span
    assert (films[2].film, films[2].budget, films[2].box_office) == ("Beta Film", "$20 million", "$100–120 million")
    assert films[2].release_date == "2006-07-08"
    assert films[3].box_office == "$45,000"
    # US entry rejected ("(United States)"), first entry too short, no cell
    # span: the cell's own text
    assert films[3].release_date == "May 2007"
    assert films[4].film is None


def test_credit_items(spark, pages):
    rows = P.credit_items(P.extract(pages)).orderBy("seq").collect()
    got = [(r.page_id, r.kind, r.value) for r in rows]
    assert (1, "actor", "Ann Actor") in got and (1, "actor", "Bob Bare") in got
    # list branch: link texts first, then bare texts of the entries
    a1 = [v for p, k, v in got if p == 1 and k == "actor"]
    assert a1 == ["Ann Actor", "Beyoncé", "Bob Bare", "(voice)"]
    assert [v for p, k, v in got if p == 1 and k == "prod_co"] == ["Studio One", ", Studio Two"]
    assert [v for p, k, v in got if p == 1 and k == "distributor"] == ["Dist Co", "(US)", "Other Dist"]
    # inline branch
    assert [v for p, k, v in got if p == 2 and k == "director"] == ["Eve Else", "Dana Director"]
    # a list without entries falls back to the cell's text
    assert [v for p, k, v in got if p == 3 and k == "actor"] == ["beyonce"]


def test_list_links(spark, pages):
    links = P.list_links(P.extract(pages)).where(F.col("page_id") == 4).orderBy("ord").collect()
    hrefs = [r.href for r in links]
    assert hrefs == ["https://films.example.org/wiki/Alpha", LIST_URL, "https://films.example.org/wiki/Beta",
                     "https://films.example.org/wiki/Alpha"]
    distinct = sorted(r.href for r in P.distinct_links(P.list_links(P.extract(pages))).collect())
    assert distinct == ["https://films.example.org/wiki/Alpha", "https://films.example.org/wiki/Beta"]


def test_page_scan(spark, pages):
    out = {r.page_id: (r.url_number, r.in_scope) for r in P.page_scan(pages, *P.YEARS).collect()}
    assert out[4] == (2005, True) and out[1] == (None, None)


def test_pages_to_reports(spark, pages):
    ex = P.extract(pages)
    st = S.build_star(P.film_items(ex), P.credit_items(ex))
    by_name = {r.actor: r for r in S.actor_report(st).collect()}
    # Beyoncé / BEYONCE / "beyonce " are one actor, first spelling kept;
    # Gamma has box office 0.045 (dollars), Alpha 300, Beta 110
    b = by_name["Beyoncé"]
    assert b.film_count == 3
    assert b.box_office_max == Decimal("300.000000") and b.box_office_min == Decimal("0.045000")
    assert "(voice)" not in by_name  # junk-only credit dropped
    movies = {r.movie: r for r in st.movies.collect()}
    assert movies["Gamma Film"].release_date.isoformat() == "2007-05-01"
    dists = S.distributor_report(st).collect()
    assert {r.distributor for r in dists} >= {"Dist Co", "Other Dist", "All distributors"}


def test_run_from_pages_writes_reports(spark, pages):
    import glob
    import tempfile
    out = tempfile.mkdtemp(prefix="cs-pages-")
    paths = S.run_from_pages(spark, pages, out)
    text = open(paths["by_actor"], encoding="utf-8").read()
    assert text.splitlines()[0].startswith("actor,box office max (in millions)")
    assert "Beyoncé,300.000000,0.045000" in text


def test_order_of_items_on_a_crowded_page(spark):
    """Over 4,096 values on one page, in several kinds: seq stays unique and
    keeps page, kind and position in order."""
    names = "".join(f"<li>Name {i}</li>" for i in range(5000))
    html = f"""<h1 id="firstHeading"><i>Crowd</i></h1><table><tbody>
      <tr><th>Starring</th><td><div><ul>{names}</ul></div></td></tr>
      <tr><th>Directed by</th><td><div><ul>{names}</ul></div></td></tr></tbody></table>"""
    pages = spark.createDataFrame([(i, None, html) for i in (1, 2)], "page_id long, url string, html string")
    rows = P.credit_items(P.extract(pages)).orderBy("seq").collect()
    assert len({r.seq for r in rows}) == len(rows) == 20_000
    assert [(r.page_id, r.kind) for r in rows[::5000]] == [(1, "actor"), (1, "director"), (2, "actor"), (2, "director")]
    assert [r.value for r in rows[:5000]] == [f"Name {i}" for i in range(5000)]


def test_list_years_prune_folders(spark, tmp_path):
    urls = [f"https://en.wikipedia.org/wiki/List_of_American_films_of_{y}" for y in (2002, 2003, 2003, 2022, 2023)] + ["https://x/y", None]
    pages = spark.createDataFrame([(k, u, f"<p>{k}</p>") for k, u in enumerate(urls)], "page_id long, url string, html string")
    assert sorted(r.page_id for r in P.list_pages(pages).collect()) == [1, 2, 3]
    P.write_pages_by_year(pages, f"{tmp_path}/pages")
    kept = P.list_pages(spark.read.parquet(f"{tmp_path}/pages"))
    assert sorted((r.page_id, r.list_year) for r in kept.collect()) == [(1, 2003), (2, 2003), (3, 2022)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(list_year" in plan and "Filter" not in plan.split("FileScan")[0]


def test_trees_are_undone_and_pages_come_in_parts():
    """A page's tree goes with its last name, without a collection of cycles;
    a large batch is not held as Python values as a whole."""
    import gc

    import pyarrow as pa

    from creditstats.sources import html_tree

    def nodes():
        return sum(type(o) is html_tree.Node for o in gc.get_objects())

    html = "<html><nav><ul><li><a href='/a'>A</a> b</li></ul></nav>" + "<div><p>x</p></div>" * 50 + "</html>"
    n = 3 * P.PAGES_AT_ONCE + 1
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(n)), "url": ["http://h/"] * n, "html": [html] * (n - 1) + [None]})
    gc.collect()
    gc.disable()
    try:
        before = nodes()
        out = list(P._extract_batches([batch]))
        assert nodes() == before
    finally:
        gc.enable()
    assert [b.num_rows for b in out] == [P.PAGES_AT_ONCE] * 3 + [1]
    found = [r for b in out for r in b.to_pylist()]
    assert [r["page_id"] for r in found] == list(range(n)) and found[0]["nav_items"] == ["A", " b"] and found[-1]["nav_items"] == []
