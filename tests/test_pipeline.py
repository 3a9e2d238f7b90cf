"""Cleaning, Bayesian summary and the compiled legacy genres on literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from kinora.operators import catalog, ratings
from kinora.plans.build import CatalogueBuild

MOVIES = "movie_id bigint, title string, genres string"
RATINGS = "user_id bigint, movie_id bigint, rating double, timestamp bigint"


def build(spark, movies, rates, m=15):
    return CatalogueBuild(spark.createDataFrame(movies, MOVIES), spark.createDataFrame(rates, RATINGS), m=m)


def test_bayesian_hand_computed(spark):
    b = build(spark, [(1, "A (2000)", "X"), (2, "B (2000)", "X"), (3, "C (2000)", "X")],
              [(1, 1, 5.0, 1), (2, 1, 5.0, 1), (3, 2, 5.0, 1), (4, 3, 1.0, 1), (5, 3, 1.0, 1)], m=5)
    got = {r.movie_id: r.popularity_score for r in b.ratings_summary.collect()}
    assert got == {1: 3.857, 2: 3.667, 3: 2.714}
    assert got[1] > got[2]


def test_cleaning_order_and_metrics(spark):
    movies = [(1, "  Dup (1990) ", "A"), (2, "Dup (1990)", "B"), (3, "Solo (no genres)", "(no genres listed)")]
    rates = [
        (10, 1, 9.0, 1), (10, 1, 4.0, 2),      # invalid first copy kills the valid second
        (11, 1, float("nan"), 1), (12, 1, None, 1),
        (13, 2, 4.0, 1),                        # item 2 lost its title to item 1 -> orphan
        (14, 3, 0.5, 5), (15, 3, 5.0, 6), (16, 99, 3.0, 1),
    ]
    b = build(spark, movies, rates)
    clean = {r.movie_id: r.title for r in b.clean_movies.collect()}
    assert clean == {1: "Dup (1990)", 3: "Solo (no genres)"}
    from kinora.operators import metrics
    m = metrics.cleaning_metrics(spark, b.raw_movies, b.clean_movies, b.item_stats, b.known_stats).first()
    assert (m.ratings_initial, m.ratings_deduplicated, m.ratings_invalid_dropped,
            m.ratings_orphans_dropped, m.ratings_cleaned) == (8, 1, 3, 2, 2)
    v = metrics.validate_raw(spark, b.raw_movies, b.item_stats).first()
    assert (v.duplicate_ratings, v.invalid_ratings, v.orphan_ratings) == (1, 3, 1)
    t = {r.movie_id: r for r in b.transformed.collect()}
    assert t[1].rating_count == 0 and t[1].avg_rating == 0.0
    assert t[1].popularity_score == round(0.5 * 2.75, 3)


def test_compile_genres(spark):
    names = ["Action", "Sci-Fi", "Comedy", "unknown"]
    df = spark.createDataFrame([(1, 1, 0, 0), (0, 0, 0, 1), (0, 0, 1, 1)], "g_0 int, g_1 int, g_2 int, g_3 int")
    got = [r[0] for r in df.select(catalog.compile_genres(names)).collect()]
    assert got == ["Action|Sci-Fi", "Unknown", "Comedy"]


def test_popular_ranks_are_contiguous(spark):
    from tests_util import sf_build
    b = sf_build(spark)
    ranks = sorted(r["rank"] for r in b.popular_movies(20).collect())
    assert ranks == list(range(1, 21))


def test_hot_pair_collapses_map_side(spark):
    """One (user, item) pair holding a third of all rating rows: the keep-first
    result is exact and the plan reduces the pair before its shuffle."""
    hot = spark.range(0, 3000).select(F.lit(7).cast("bigint").alias("user_id"), F.lit(1).cast("bigint").alias("movie_id"),
                                       (F.lit(0.5) + (F.col("id") % 10) / 2).alias("rating"),
                                       (F.lit(1000) - F.col("id") % 997).cast("bigint").alias("timestamp"))
    cold = spark.range(0, 6000).select((F.col("id") + 100).alias("user_id"), (F.col("id") % 3 + 1).alias("movie_id"),
                                        F.lit(4.0).alias("rating"), F.col("id").alias("timestamp"))
    pairs = ratings.rating_pairs(hot.unionByName(cold).repartition(8))
    row = pairs.where("user_id = 7").first()
    # first copy by (timestamp, rating): timestamp 4 is reached by ids 996, 1993, 2990 -> ratings 3.5, 2.0, 0.5
    assert (row.copies, row.timestamp, row.rating) == (3000, 4, 0.5)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan
