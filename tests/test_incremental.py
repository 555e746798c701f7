"""A star kept up to date equals one load of all items."""
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from creditstats.incremental import star_store
from creditstats.plans import star as S
from creditstats.schema import CREDIT_ITEMS, FILM_ITEMS


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """These tables have a few rows each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _items(spark, films, credits):
    """films: (seq, film, box office, date); credits: (seq, film, kind, value)."""
    f = [(Decimal(s), None, film, "$1 million", box, date) for s, film, box, date in films]
    c = [(Decimal(s), None, film, kind, value) for s, film, kind, value in credits]
    return spark.createDataFrame(f, FILM_ITEMS), spark.createDataFrame(c, CREDIT_ITEMS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _same(spark, store, films, credits, tables=True):
    """Tables and reports of the store equal those of one load."""
    whole = S.build_star(*_items(spark, films, credits))
    kept = star_store.read_star(store)
    for name, columns in (("movies", ["movie_key", "movie", "budget", "box_office", "release_date"]),
                          ("dimensions", ["kind", "entity_key", "entity"]), ("bridges", ["kind", "movie_key", "entity_key"]),
                          ("rejects", ["seq", "kind", "reason", "raw"])) if tables else ():
        assert _rows(getattr(kept, name).select(*columns)) == _rows(getattr(whole, name).select(*columns)), name
    for name, (fn, _, _) in S.REPORTS.items():
        assert _rows(star_store.read_report(store, name)) == _rows(fn(whole)), name


def _folder():
    return tempfile.mkdtemp(prefix="cs-store-")


def test_a_lowered_maximum(spark):
    """The film that held an actor's maximum gets a lower, then no box office,
    then another year."""
    store = star_store.open_store(spark, _folder(), 4)
    films = [(1, "One", "$90 million", "2005"), (2, "Two", "$10 million", "2005"), (3, "Three", "$50 million", "2006")]
    credits = [(10 + k, film, kind, "Ann") for k, (film, kind) in enumerate((f, k) for f in ("One", "Two", "Three") for k in ("actor", "distributor"))]
    assert star_store.apply(store, *_items(spark, films, credits), "log", 0)
    for position, change in enumerate([(20, "ONE", "$20 million", "2005"), (21, "one ", None, "2005"), (22, "Two", "$10 million", "1999")], 1):
        assert star_store.apply(store, *_items(spark, [change], []), "log", position)
        films.append(change)
        _same(spark, store, films, credits, tables=position == 3)
    (ann,) = star_store.read_report(store, "by_actor").collect()
    assert (ann.box_office_max, ann.film_count) == (50, 2)


def test_random_batches(spark):
    """Films change their facts, credits come late or twice, items are lost;
    after every other batch all tables and reports equal one load."""
    rng = random.Random(11)
    store = star_store.open_store(spark, _folder(), 3)
    films, credits, seq = [], [], 0
    for position in range(4):
        new_films, new_credits = [], []
        for _ in range(25):
            seq += 1
            title = rng.choice(["Film ", "FILM ", "film "]) + str(rng.randrange(12))
            if rng.random() < 0.4:
                new_films.append((seq, title, rng.choice([None, "$5 million", f"${rng.randrange(1, 9)} million", "$7.25 million"]),
                                  rng.choice(["2005", "2006", "May 3, 2005", "unknown", None])))
            else:
                new_credits.append((seq, title if rng.random() < 0.95 else None, rng.choice(["actor", "director", "distributor", "prod_co"]),
                                    rng.choice(["Ann", "ANN ", "Bo", "Ćy", "cy", ",Di", "()", "E" * 101])))
        assert star_store.apply(store, *_items(spark, new_films, new_credits), "log", position)
        films, credits = films + new_films, credits + new_credits
        if position % 2:
            _same(spark, store, films, credits)
    ids = sorted(r[0] for r in star_store.read_star(store).movies.select("movie_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    for kind in ("actor", "director", "distributor", "prod_co"):
        ids = sorted(r[0] for r in star_store.read_star(store).dimensions.where(F.col("kind") == kind).select("entity_id").collect())
        assert ids == list(range(1, len(ids) + 1))


def test_ids_stay_and_untouched_buckets_are_not_rewritten(spark):
    store = star_store.open_store(spark, _folder(), 16)
    films = [(k, f"Film {k}", "$1 million", "2005") for k in range(60)]
    credits = [(100 + k, f"Film {k}", "actor", f"Name {k}") for k in range(60)]
    assert star_store.load_new(store, *_items(spark, films, credits), refresh=False)
    first = store.manifest()
    ids = dict(map(tuple, star_store.read_star(store).movies.select("movie_key", "movie_id").collect()))
    assert ids == {f"film {k}": k + 1 for k in range(60)}  # in order of arrival
    more = [(200, "Film 7", "$2 million", "2005"), (201, "New", "$2 million", "2005")]
    assert star_store.load_new(store, *_items(spark, films + more, credits), refresh=False)  # the log again, with two more items
    second = store.manifest()
    for table in ("movies", "dimensions", "bridges", "credited", "state"):
        changed = {b for b in second["tables"][table] if second["tables"][table][b] != first["tables"][table].get(b)}
        assert len(changed) <= 2, table
    assert dict(map(tuple, star_store.read_star(store).movies.select("movie_key", "movie_id").collect())) == {**ids, "new": 61}
    assert not star_store.load_new(store, *_items(spark, films + more, credits))  # nothing behind the position
    assert store.manifest() == second


def test_a_crash_before_the_manifest_loses_nothing(spark, monkeypatch):
    store = star_store.open_store(spark, _folder(), 4)
    one = [(1, "One", "$9 million", "2005")], [(2, "One", "actor", "Ann")]
    two = [(3, "One", "$4 million", "2006")], [(4, "One", "actor", "Bo")]
    star_store.apply(store, *_items(spark, *one), "log", 0)

    def crash(manifest):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(store, "commit", crash)
        with pytest.raises(RuntimeError, match="crash"):
            star_store.apply(store, *_items(spark, *two), "log", 1)
    _same(spark, store, *one, tables=False)
    assert star_store.apply(store, *_items(spark, *two), "log", 1)
    assert not star_store.apply(store, *_items(spark, *two), "log", 1)  # a repeated batch changes nothing
    store.vacuum(keep=1)
    _same(spark, store, one[0] + two[0], one[1] + two[1])
    named = {f for held in store.manifest()["tables"].values() for f in held.values()}
    assert all(f"data/movies/{f}" in named for f in store._children(f"{store.path}/data/movies"))


def test_reads_stay_flat_over_many_changes(spark):
    """Folders to read do not grow with the number of changes."""
    store = star_store.open_store(spark, _folder(), 2)
    schema = star_store.TABLES["bridges"][0]
    for k in range(40):
        new = {**store.manifest(), "version": k + 1}
        rows = store.read(new, "bridges").unionByName(spark.createDataFrame([("actor", "ann", f"film {k}")], schema)) if k % 20 == 0 else None
        if rows is not None:
            store.write(new, "bridges", rows, range(2))
        store.append(new, "rejects", schema, spark.createDataFrame([("actor", "ann", f"film {k}")], schema).coalesce(1))
        store.commit(new)
    m = store.manifest()
    assert len(m["tables"]["bridges"]) <= 2 and store.read(m, "bridges").count() == 2
    assert len(m["logs"]["rejects"]) <= 5 and store.read_log(m, "rejects", schema).count() == 40


def test_changed_facts_do_not_rewrite_bridges(spark):
    """Loads that bring no new pair leave the bridges' files as they are; a
    film that loses its box office leaves its entities' films and state."""
    store = star_store.open_store(spark, _folder(), 4)
    films = [(k, f"Film {k}", f"${k + 1} million", "2005") for k in range(12)]
    credits = [(100 + k, f"Film {k}", kind, f"Name {k % 3}") for k in range(12) for kind in ("actor", "prod_co")]
    credits = [(100 + i, *c[1:]) for i, c in enumerate(credits)]
    assert star_store.load_new(store, *_items(spark, films, credits))
    first = store.manifest()
    changed = [(200 + k, f"Film {k}", None if k % 4 == 0 else f"${k + 5} million", "2006") for k in range(12)]
    again = [(300 + i, *c[1:]) for i, c in enumerate(credits)]
    assert star_store.load_new(store, *_items(spark, films + changed, credits + again))
    second = store.manifest()
    assert second["tables"]["bridges"] == first["tables"]["bridges"]
    assert second["tables"]["credited"] != first["tables"]["credited"]
    _same(spark, store, films + changed, credits + again)
    assert store.read(second, "credited").count() == 18
