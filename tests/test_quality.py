"""Quality checks report zero on a real build and flag broken tables."""

from pyspark.sql import functions as F

from kinora.operators import quality, serving
from tests_util import sf_build


def test_checks_clean_and_broken(spark):
    b = sf_build(spark)
    t = b.serving(5)
    rows = quality.dq_checks(t).collect()
    assert rows and all(r.violations == 0 for r in rows)
    n = quality.dq_neighbours(t.recommendations).first()
    assert (n.score_out_of_range, n.self_pairs, n.order_violations, n.rank_gaps) == (0, 0, 0, 0)
    broken = t.recommendations.unionByName(t.recommendations.limit(1))
    bad = serving.ServingTables(t.movies, t.ratings_summary, broken, t.popular_movies)
    v = {(r.table_name, r.check_name): r.violations for r in quality.dq_checks(bad).collect()}
    assert v[("recommendations", "primary_key")] == 1


def test_top_n_per_key_matches_plain_window(spark):
    from pyspark.sql import Window
    from kinora.operators.linkage import top_n_per_key
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 50).alias("key"),   # a third on key 0
        F.col("id").alias("ext_id"), (F.col("id") * 7919 % 1000).alias("votes"))
    order = [F.col("votes").desc(), F.col("ext_id")]
    a = top_n_per_key(df, ["key"], order, 10, "ext_id")
    b = df.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where("r <= 10").drop("r")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_each_violation_is_counted_from_one_scan(spark):
    from kinora.operators import quality, serving
    movies = spark.createDataFrame([(1, "a", "g"), (1, "b", None), (None, "c", "g"), (2, None, None)], "movie_id bigint, title string, genres string")
    summary = spark.createDataFrame([(1, 1.0, 1, 1.0), (9, None, 1, 1.0)], "movie_id bigint, avg_rating double, rating_count bigint, popularity_score double")
    recs = spark.createDataFrame([(1, 2, 1, 0.5), (1, 8, 1, 0.5), (7, None, 2, None)], "movie_id bigint, recommended_movie_id bigint, rank int, similarity_score double")
    popular = spark.createDataFrame([(None, 1, 2.0)], "movie_id bigint, rank int, popularity_score double")
    rows = quality.dq_checks(serving.ServingTables(movies, summary, recs, popular))
    got = {(r.table_name, r.check_name): r.violations for r in rows.collect()}
    assert got == {("movies", "primary_key"): 1, ("movies", "not_null"): 4, ("ratings_summary", "primary_key"): 0, ("ratings_summary", "not_null"): 1,
                   ("recommendations", "primary_key"): 1, ("recommendations", "not_null"): 2, ("popular_movies", "primary_key"): 0,
                   ("popular_movies", "not_null"): 1, ("ratings_summary", "references_movies:movie_id"): 1, ("popular_movies", "references_movies:movie_id"): 1,
                   ("recommendations", "references_movies:movie_id"): 1, ("recommendations", "references_movies:recommended_movie_id"): 2}
