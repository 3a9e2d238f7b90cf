"""Recommendation edge cases on literal serving tables."""

from pyspark.sql import functions as F

from kinora.operators import recommend, serving


def tables(spark, with_recs=True):
    movies = spark.createDataFrame([
        (1, "Alpha (1990)", "Action|Drama", 1990), (2, "Beta (1991)", "Drama", 1991),
        (3, "Gamma 100% (1992)", "Comedy", 1992), (4, "Lonely (1993)", "Unknown", 1993),
        (5, "alpha beta (1994)", "Action", 1994)], "movie_id bigint, title string, genres string, release_year int")
    summary = spark.createDataFrame([(1, 50, 4.0, 3.9), (2, 40, 3.5, 3.4), (3, 10, 3.0, 3.1), (5, 5, 2.0, 2.5)],
                                    "movie_id bigint, rating_count bigint, avg_rating double, popularity_score double")
    recs = spark.createDataFrame([(1, 2, 1, 0.5), (1, 5, 2, 0.4), (2, 1, 1, 0.5), (5, 1, 1, 0.4)],
                                 "movie_id bigint, recommended_movie_id bigint, rank int, similarity_score double")
    pop = spark.createDataFrame([(1, 1, 3.9), (4, 2, 3.6), (2, 3, 3.4), (3, 4, 3.1), (5, 5, 2.5)],
                                "movie_id bigint, rank int, popularity_score double")
    return serving.ServingTables(movies, summary, recs, pop)


def test_fallback_only_without_neighbours(spark):
    t = tables(spark)
    reqs = spark.createDataFrame([(10, 1), (11, 4), (12, 999999)], "request_id bigint, movie_id bigint")
    rows = recommend.recommend(t, reqs, 3).collect()
    by = {}
    for r in rows:
        by.setdefault(r.request_id, []).append(r)
    assert [r.status for r in by[10]] == ["ok", "ok"]            # fewer than k is not a fallback
    fb = sorted(by[11], key=lambda r: r["rank"])
    # popular list minus the source, unrated entry (4) dropped by the join, re-ranked from 1
    assert [(r["rank"], r.movie_id, r.similarity_score, r.is_fallback) for r in fb] == [
        (1, 1, 0.0, True), (2, 2, 0.0, True), (3, 3, 0.0, True)]
    assert by[12][0].status == "not_found" and by[12][0].movie_id is None


def test_search_and_title_requests(spark):
    t = tables(spark)
    q = spark.createDataFrame([("a", "alpha"), ("b", "100%"), ("c", "zzz"), ("d", "%"), ("e", "b_ta")],
                              "query_id string, query string")
    res = recommend.search_batch(t, q, 5).collect()
    got = {}
    for r in res:
        got.setdefault(r.query_id, []).append((r.position, r.movie_id))
    assert sorted(got["a"]) == [(1, 1), (2, 5)]         # prefix matches ranked by popularity
    assert sorted(got["b"]) == [(1, 3)]
    assert "c" not in got
    assert len(got["d"]) == 5                           # wildcard-only query matches everything
    assert sorted(got["e"]) == [(1, 2), (2, 5)]
    reqs = spark.createDataFrame([("k1", None, "   "), ("k2", None, "zzz"), ("k3", None, "beta"), ("k4", 3, None)],
                                 "request_key string, request_id bigint, title string")
    out = recommend.recommend_by_request(t, reqs, 2).collect()
    status = {}
    for r in out:
        status.setdefault(r.request_key, set()).add(r.status)
    assert status == {"k1": {"rejected"}, "k2": {"no_match"}, "k3": {"ok"}, "k4": {"fallback"}}


def test_serving_reads(spark):
    t = tables(spark)
    assert [r.movie_id for r in serving.list_movies(t, page=1, page_size=2).collect()] == [1, 2]
    assert [r.movie_id for r in serving.list_movies(t, page=2, page_size=2).collect()] == [3, 5]
    assert [r.movie_id for r in serving.list_movies(t, sort_by="bogus", page_size=1).collect()] == [1]
    assert serving.list_total(t, "action").first().total == 2
    assert serving.search_titles(t, "Supercalifragilistic12345NonExistent").count() == 0
    import pytest
    with pytest.raises(ValueError):
        serving.search_titles(t, "   ")
    with pytest.raises(ValueError):
        serving.list_movies(t, page_size=101)
    g = {r.genre: (r["count"], r.avg_rating) for r in serving.genre_stats(t).collect()}
    assert g == {"Action": (2, 3.0), "Drama": (2, 3.75), "Comedy": (1, 3.0)}
    assert [r.genre for r in serving.genre_list(t).orderBy("genre").collect()] == ["Action", "Comedy", "Drama"]
    board = serving.popular_list(t, 5).collect()
    assert [r["rank"] for r in board] == [1, 3, 4, 5]   # unrated leaderboard entry drops out, rank kept


def test_each_request_has_its_own_top_k_or_is_rejected(spark):
    t = tables(spark)
    reqs = spark.createDataFrame([("a", 1, None, 1), ("b", 1, None, None), ("c", 4, None, 100), ("d", 1, None, 0), ("e", None, "alpha", 101),
                                  ("f", None, "alpha beta", 1), ("g", None, " ", 5), ("h", None, "zzz", 3), ("i", 4, None, 2)],
                                 "request_key string, request_id bigint, title string, top_k int")
    got = {}
    for r in recommend.recommend_by_request(t, reqs, 2).collect():
        got.setdefault(r.request_key, []).append(r.status)
    assert got == {"a": ["ok"], "b": ["ok"] * 2, "c": ["fallback"] * 4, "d": ["rejected"], "e": ["rejected"], "f": ["ok"],
                   "g": ["rejected"], "h": ["no_match"], "i": ["fallback"] * 2}
    by_id = reqs.where("request_id is not null").select(F.col("request_key").alias("request_id"), F.col("request_id").alias("movie_id"), "top_k")
    assert {r.status for r in recommend.recommend(t, by_id).where("request_id = 'd'").collect()} == {"rejected"}
    reasons = {r.request_key: r.reason for r in recommend.validate_requests(reqs).collect()}
    assert (reasons["d"], reasons["g"], reasons["a"]) == ("top_k_out_of_range", "missing_id_and_title", "ok")


def test_title_index_is_built_once_and_chunks_change_nothing(spark):
    t = tables(spark)
    q = spark.createDataFrame([("a", "alpha"), ("b", "%"), ("c", "a (19"), ("d", "zzz")], "query_id string, query string")

    def rows(t):
        return sorted(map(tuple, recommend.search_batch(t, q, 5).collect()))
    want = rows(t)
    index = t.search_index(recommend.TitleIndex)
    assert rows(t) == want and t.search_index(recommend.TitleIndex) is index
    small = tables(spark)
    small.search_index(lambda t: recommend.TitleIndex(t, postings=1))
    assert rows(small) == want
    assert small.search_index(None).postings.agg(F.max(F.size("ids"))).first()[0] <= 5
    df = {r.gram: r.df for r in index.grams.collect()}
    assert df[recommend.MATCH_ALL] == 5 and df["alp"] == 2


def test_entry_without_an_optional_library():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as E; "
            "from kinora.plans.registry import QUERIES; assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(QUERIES)")
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, timeout=120).returncode == 0
