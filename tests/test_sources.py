"""File sources, sinks and the streaming append."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kinora.sources import files, sinks
from kinora.streaming import feed_append


def scratch():
    return tempfile.mkdtemp(prefix="kinora-test-")


def test_missing_source(spark):
    with pytest.raises(files.MissingSourceError):
        files.read_movies_csv(spark, os.path.join(scratch(), "nope", "movies.csv"))


def test_csv_roundtrip_with_quotes(spark):
    d = scratch()
    df = spark.createDataFrame([(1, 'Say "Hi", Bob (1999)', "A|B")], "movieId bigint, title string, genres string")
    sinks.land_csv(df, f"{d}/m")
    back = files.read_movies_csv(spark, f"{d}/m").first()
    assert (back.movie_id, back.title, back.genres) == (1, 'Say "Hi", Bob (1999)', "A|B")


def test_json_cache_drops_corrupt_file(spark):
    d = scratch()
    good = spark.createDataFrame([(1, True, 101), (2, False, None)], "movie_id bigint, found boolean, meta_id bigint")
    good.write.json(f"{d}/a")
    spark.createDataFrame([('{"movie_id": 3, "found": true, "meta_id": 103}',), ('{"movie_id": 4, "fou',)],
                          "value string").coalesce(1).write.text(f"{d}/b")
    got = files.read_json_cache(spark, f"{d}/*", good.schema).orderBy("movie_id").collect()
    assert [(r.movie_id, r.found, r.meta_id) for r in got] == [(1, True, 101), (2, False, None)]


def test_versioned_write_reads_newest(spark):
    d = scratch()
    sinks.write_version(spark.createDataFrame([(1, "a")], "k bigint, v string"), d, 1)
    sinks.write_version(spark.createDataFrame([(1, "b"), (2, "c")], "k bigint, v string"), d, 2)
    assert sorted(tuple(r) for r in sinks.read_latest(spark, d).collect()) == [(1, "b"), (2, "c")]


def test_stream_append_pages_and_replay(spark):
    d = scratch()
    feed = spark.createDataFrame([
        (1, 0, "Alpha", "2001-01-01", [28], 8.0), (1, 1, "Old", "1990-01-01", [28], 6.0),
        (2, 0, "Beta", "", [], None)],
        "page int, pos int, title string, release_date string, genre_ids array<int>, vote_average double")
    feed_append.land_feed(feed, f"{d}/landing")
    base = spark.createDataFrame([("Old (1990)",)], "title string")
    args = (f"{d}/landing", base, f"{d}/items", f"{d}/ratings", f"{d}/ckpt", 42)
    feed_append.run_feed_append(spark, *args)
    items = spark.read.parquet(f"{d}/items").orderBy("movie_id").collect()
    assert [(r.movie_id, r.title) for r in items] == [(600000, "Alpha (2001)"), (600001, "Beta")]
    # a second run sees no new files and changes nothing; a fresh checkpoint replays batch 0 in place
    feed_append.run_feed_append(spark, *args)
    feed_append.run_feed_append(spark, f"{d}/landing", base, f"{d}/items", f"{d}/ratings", f"{d}/ckpt2", 42)
    assert spark.read.parquet(f"{d}/items").count() == 2
    assert spark.read.parquet(f"{d}/ratings").count() == 20


def test_spread_only_touches_small_scans(spark):
    from kinora.session import default_parallelism, spread
    many = spark.range(0, 1000, numPartitions=default_parallelism(spark) * 2)
    assert spread(many) is many                      # enough splits: no shuffle added
    one = spark.range(0, 1000, numPartitions=1)
    spreaded = spread(one, "id")
    assert spreaded.rdd.getNumPartitions() > 1 and spreaded.count() == 1000


def test_broken_cache_files_are_quarantined(spark, tmp_path):
    from kinora.sources import files
    for name, lines in (("a", ['{"movie_id": 1, "found": true}', '{"movie_id": 2, "found": false}']),
                        ("b", ['{"movie_id": 3, "found": true}', '{"movie_id": 4, "fou', "nonsense"])):
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "movie_id bigint, found boolean").schema
    assert sorted(r.movie_id for r in files.read_json_cache(spark, str(tmp_path), schema).collect()) == [1, 2]
    [bad] = files.quarantined_files(spark, str(tmp_path), schema).collect()
    assert bad.file.endswith("b.json") and bad.broken_lines == 2


def test_readiness_and_store_status(spark, tmp_path):
    from kinora.operators import counters
    from kinora.sources import files

    def use(df):
        def run():
            c = counters.Counted(df)
            c.rows.write.format("noop").mode("overwrite").save()
            return c
        return run
    got = counters.readiness(spark, {"full": use(spark.range(3)), "empty": use(spark.range(0)),
                                     "lost": lambda: counters.Counted(files.read_ratings_csv(spark, str(tmp_path / "none.csv")))})
    assert [tuple(r) for r in got.collect()] == [("full", 3, True), ("empty", 0, False), ("lost", 0, False)]
    rows = counters.store_status(spark, {"movies": 3, "popular_movies": 49}, {"popular_movies": 50}).collect()
    assert [(r.ok, r.status) for r in rows] == [(True, "unhealthy"), (False, "unhealthy")]
    assert counters.store_status(spark, {"movies": 1}, {}).first().status == "healthy"
    [row] = counters.progress(spark, 6, {"rows": 2, "matched": 1}, 3).collect()
    assert (row.catalog_count, row.todo_count, row.matched_count, row.coverage_pct) == (8, 2, 1, 50.0)
