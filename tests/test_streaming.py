"""The streamed star schema and its reports equal the batch ones."""
import tempfile

from conftest import SF001
from creditstats.plans import star as S
from creditstats.plans.driver_items import driver_items
from creditstats.schema import CREDIT_ITEMS, FILM_ITEMS
from creditstats.streaming import star_stream


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch(spark):
    films, credits = driver_items(spark, SF001)
    root = tempfile.mkdtemp(prefix="cs-stream-")
    # several input files, so state crosses batches
    films.repartition(2).write.parquet(f"{root}/in/films")
    credits.repartition(2).write.parquet(f"{root}/in/credits")
    fs = spark.readStream.schema(FILM_ITEMS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/films")
    cs = spark.readStream.schema(CREDIT_ITEMS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/credits")
    query = star_stream.start(fs, cs, f"{root}/out", checkpoint_root=f"{root}/ckpt", buckets=4)
    query.awaitTermination(600)
    assert query.exception() is None
    # one query, and one scan of the source a batch: every item is read once
    batch_films, batch_credits = spark.read.parquet(f"{root}/in/films"), spark.read.parquet(f"{root}/in/credits")
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 2
    assert sum(p["numInputRows"] for p in batches) == batch_films.count() + batch_credits.count()

    streamed = star_stream.read_star(spark, f"{root}/out")
    batch = S.build_star(batch_films, batch_credits)
    for name, columns in (("movies", ["movie_key", "movie", "budget", "box_office", "release_date"]),
                          ("dimensions", ["kind", "entity_key", "entity"]), ("bridges", ["kind", "movie_key", "entity_key"]),
                          ("rejects", ["seq", "kind", "reason", "raw"])):
        assert _sorted(getattr(streamed, name).select(*columns)) == _sorted(getattr(batch, name).select(*columns)), name
    kept = star_stream.read_reports(spark, f"{root}/out")
    for name, (fn, _, _) in S.REPORTS.items():
        wanted = _sorted(fn(batch))
        assert _sorted(kept[name]) == wanted and _sorted(fn(streamed)) == wanted, name
    # a second start finds nothing new; a retried batch is skipped
    before = star_stream.star_store.open_store(spark, f"{root}/out").manifest()
    again = star_stream.start(fs, cs, f"{root}/out", checkpoint_root=f"{root}/ckpt")
    again.awaitTermination(600)
    star_stream.merge(f"{root}/out")(star_stream.items(batch_films, batch_credits), 1)
    assert star_stream.star_store.open_store(spark, f"{root}/out").manifest() == before


def test_empty_before_the_first_batch(spark):
    star = star_stream.read_star(spark, tempfile.mkdtemp(prefix="cs-none-"))
    assert [df.count() for df in (star.movies, star.dimensions, star.bridges, star.rejects)] == [0, 0, 0, 0]


def test_files_of_a_batch_grow_in_number(spark, monkeypatch):
    """A task writes and reads a bounded share of the items, however many."""
    import glob
    import math

    from creditstats.plans import incremental_queries as Q

    films, _ = driver_items(spark, SF001)
    monkeypatch.setattr(Q, "ITEMS_PER_FILE", 200)
    path = tempfile.mkdtemp(prefix="cs-files-") + "/films"
    Q._streamed(films, FILM_ITEMS, path)
    files = glob.glob(f"{path}/*.parquet")
    assert len(files) == Q.STREAM_BATCHES * math.ceil(films.count() / Q.STREAM_BATCHES / 200) > Q.STREAM_BATCHES
    assert max(spark.read.parquet(f).count() for f in files) <= 250
