"""Feed append: page cut-off, title skip, keep-first, ids, genres, seed ratings."""

from pyspark.sql import functions as F

from kinora.operators import append

FEED = "page int, pos int, title string, release_date string, genre_ids array<int>, vote_average double"


def test_new_items(spark):
    feed = spark.createDataFrame([
        (1, 0, "Dil, Se", "1998-08-21", [18, 10749], 7.3),
        (1, 1, "Old", "1990-01-01", [28], 6.0),            # exists already
        (2, 0, "Dil Se", "1998-01-01", [28], 9.9),          # same full title as (1, 0): skipped
        (2, 1, "New", "", [], None),                       # no genres, default vote
        (2, 2, "Odd", "2001-02-02", [4242], 0.4),           # unknown genre id, clamped rating
        (4, 0, "After gap", "2005-01-01", [28], 5.0),       # page 3 missing: dropped
    ], FEED)
    existing = spark.createDataFrame([("Old (1990)",)], "title string")
    got = [tuple(r) for r in append.new_items(feed, existing).orderBy("movie_id").collect()]
    assert got == [
        (600000, "Dil Se (1998)", "Drama|Romance", 3.5),
        (600001, "New", "(no genres listed)", 2.5),
        (600002, "Odd (2001)", "Unknown", 0.5),
    ]


def test_consecutive_ids_across_partitions(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("page"), (F.col("id") * 7 % 500).alias("pos"))
    out = append.consecutive_ids(df.repartition(7), ["page", "pos"], 100, "nid").collect()
    ordered = sorted(out, key=lambda r: (r.page, r.pos))
    assert [r.nid for r in ordered] == list(range(100, 600))


def test_seed_ratings(spark):
    items = spark.createDataFrame([(600000, 5.0), (600001, 0.5)], "movie_id bigint, seed_rating double")
    r = append.seed_ratings(items, F.lit(1234)).collect()
    assert len(r) == 20 and {x.user_id for x in r} == set(range(900, 910))
    assert all(0.5 <= x.rating <= 5.0 and x.timestamp == 1234 for x in r)


def test_all_pages_and_ids_after_the_largest(spark):
    rows = [(p, 0, f"T{p}", "", [], None) for p in range(1, 151)]
    existing = spark.createDataFrame([(700000, "x")], "movie_id bigint, title string")
    got = append.new_items(spark.createDataFrame(rows, FEED), existing).orderBy("movie_id").collect()
    assert [r.movie_id for r in got] == list(range(700001, 700151))
    assert append.new_items(spark.createDataFrame(rows, FEED), existing, max_pages=100).count() == 100


def test_ids_of_many_rows_are_distinct_and_without_gaps(spark):
    df = spark.range(200_000).select(F.xxhash64("id").alias("page"), "id")
    out = append.consecutive_ids(df, ["page"], 5, "nid").agg(F.min("nid"), F.max("nid"), F.countDistinct("nid")).first()
    assert tuple(out) == (5, 200_004, 200_000)


def test_stream_keeps_pages_that_land_later(spark, tmp_path):
    from kinora.streaming.feed_append import land_feed, run_feed_append
    base = spark.createDataFrame([(1, "x")], "movie_id bigint, title string")
    paths = [str(tmp_path / n) for n in ("landing", "items", "ratings", "check")]
    for pages in ((2, 4), (1,), (3,)):
        rows = [(p, i, f"T{p}-{i}", "", [], None) for p in pages for i in range(2)]
        land_feed(spark.createDataFrame(rows, FEED), paths[0])
        run_feed_append(spark, *paths[:1], base, *paths[1:], 7)
    items = spark.read.parquet(paths[1]).collect()
    assert len(items) == 8 and len({r.movie_id for r in items}) == 8


def _feed(spark, pages):
    return spark.createDataFrame([(p, i, f"T{p}-{i}", "", [], None) for p in pages for i in range(2)], FEED)


def _paths(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "items", "ratings", "check")]


def test_stream_skips_raised_pages_and_stops_at_refused_ones(spark, tmp_path):
    from kinora.streaming.feed_append import land_feed, run_feed_append
    base = spark.createDataFrame([(1, "T5-1"), (600001, "y")], "movie_id bigint, title string")
    paths = _paths(tmp_path)
    failures = spark.createDataFrame([(2, None, "timed out"), (4, 503, None), (6, None, None)], "page int, status int, error string")
    land_feed(_feed(spark, (1, 3, 5, 7)), paths[0], failures)
    run_feed_append(spark, paths[0], base, *paths[1:], 7)

    def titles():
        return {r.movie_id: r.title for r in spark.read.parquet(paths[1]).collect()}
    assert titles() == {600002: "T1-0", 600003: "T1-1", 600004: "T3-0", 600005: "T3-1"}
    land_feed(_feed(spark, (4,)), paths[0])  # the refused page is repeated: the walk goes on to the empty one
    run_feed_append(spark, paths[0], base, *paths[1:], 7)
    assert titles() == {600002: "T1-0", 600003: "T1-1", 600004: "T3-0", 600005: "T3-1", 600006: "T4-0", 600007: "T4-1", 600008: "T5-0"}
    land_feed(_feed(spark, (6,)), paths[0], spark.createDataFrame([(2, 200, None)], "page int, status int, error string"))
    run_feed_append(spark, paths[0], base, *paths[1:], 7)
    assert sorted(titles())[-4:] == [600009, 600010, 600011, 600012]
    assert sorted(r.batch_id for r in spark.read.parquet(paths[1] + "_walk").collect()) == [0, 1, 2]
    assert spark.read.parquet(paths[2]).count() == 10 * len(titles())


def test_a_batch_reads_no_page_the_walk_has_passed(spark, tmp_path):
    from kinora.streaming import feed_append as S
    ledger, walk = str(tmp_path / "pages"), str(tmp_path / "walk")

    def batch(pages):
        return spark.createDataFrame([(p, 200, None, [(0, f"T{p}", "", [], None)]) for p in pages], S.PAGE_SCHEMA)
    assert S.take_reachable(spark, batch(range(1, 2500)), 0, ledger, walk).count() == 2499
    rows = S.take_reachable(spark, batch([2500, 2502]), 1, ledger, walk)
    assert [r.page for r in rows.collect()] == [2500]
    scan = [line for line in rows._jdf.queryExecution().toString().split("\n") if "PartitionFilters" in line and "pages#" in line]
    assert scan and all(">= 2)" in line for line in scan)
    again = S.take_reachable(spark, batch([2500, 2502]), 1, ledger, walk)  # replayed
    assert [r.page for r in again.collect()] == [2500]
    assert sorted(r.page for r in S.take_reachable(spark, batch([2501]), 2, ledger, walk).collect()) == [2501, 2502]


def test_items_and_ratings_land_together(spark, tmp_path):
    from kinora.sources.commits import SnapshotStore
    from kinora.streaming.feed_append import land_feed, run_feed_append
    paths, store = _paths(tmp_path), SnapshotStore(spark, str(tmp_path / "store"))
    base = spark.createDataFrame([(1, "x", "g")], "movie_id bigint, title string, genres string")
    store.commit("start", {"movies": base, "ratings": spark.createDataFrame([], "user_id bigint, movie_id bigint, rating double, timestamp bigint")})
    old = store.snapshot()
    land_feed(_feed(spark, (1, 2)), paths[0])
    run_feed_append(spark, paths[0], base, *paths[1:], store=store)
    now = store.snapshot()
    assert (old.version, now.version) == (1, 2)
    assert old.read("movies").count() == 1 and old.read("ratings").count() == 0  # a pinned reader
    assert now.read("movies").count() == 5 and now.read("ratings").count() == 40
    assert now.read("ratings").select("timestamp").distinct().count() == 1


def test_a_commit_is_whole_and_made_once(spark, tmp_path):
    import pytest

    from kinora.sources.commits import SnapshotStore
    store = SnapshotStore(spark, str(tmp_path / "store"))
    one = spark.createDataFrame([(1, "a")], "id bigint, t string")
    assert store.version() == 0 and store.snapshot().tables() == []
    with pytest.raises(KeyError):
        store.snapshot().read("one")
    assert store.commit("first", {"one": one, "two": one}) == 1
    assert store.commit("first", {"one": one.unionAll(one)}) == 1  # a replay changes nothing
    failing = one.select("id", F.raise_error(F.lit("lost")).cast("string").alias("t"))
    with pytest.raises(Exception, match="lost"):
        store.commit("second", {"one": one, "two": failing})  # table one was staged already
    assert store.version() == 1 and store.snapshot().read("one").count() == 1
    assert store.commit("second", {"one": one, "two": one}) == 2
    with pytest.raises(ValueError, match="columns"):
        store.commit("third", {"one": one.select("id")})
    assert [store.snapshot(v).read("two").count() for v in (1, 2)] == [1, 2]
    with pytest.raises(ValueError):
        store.snapshot(9)
