"""Cases that the driver tables do not hold: NULLs, empty tables, names in other scripts, backslashes."""

from pyspark.sql import functions as F

from kinora.functions import text
from kinora.operators import catalog, linkage, quality, ratings


def test_null_copies_come_last(spark):
    raw = spark.createDataFrame([(1, 1, None, 5), (1, 1, 4.0, 5), (1, 1, 3.0, None)], "user_id long, movie_id long, rating double, timestamp long")
    assert ratings.rating_pairs(raw).first().rating == 4.0
    items = spark.createDataFrame([(1, None, "a"), (1, "Real (1999)", "b")], "movie_id long, title string, genres string")
    assert catalog.clean_catalog(items).first().title == "Real (1999)"


def test_checks_of_empty_tables_are_zero(spark):
    recs = spark.createDataFrame([], "movie_id long, recommended_movie_id long, rank int, similarity_score double")
    assert list(quality.dq_neighbours(recs).first()) == [0] * 5


def test_names_without_ascii_letters_are_told_apart(spark):
    df = spark.createDataFrame([("शोले",), ("दीवार",), ("",), ("Abc!",)], "n string")
    assert [r.k for r in df.select(text.link_key("n").alias("k")).collect()] == ["शोले", "दीवार", "", "abc"]
    hits = spark.createDataFrame([(7, "Wall", "दीवार", "1975-01-01", 9000, 5.0, "/p", "/b", "")],
                                 "ext_id long, title string, original_title string, release_date string, vote_count long, vote_average double, "
                                 "poster_path string, backdrop_path string, overview string")
    items = spark.createDataFrame([(1, "शोले (1975)", 1975), (2, "दीवार (1975)", 1975)], "movie_id long, title string, release_year int")
    assert [r.movie_id for r in linkage.link_items(items, hits).collect()] == [2]


def test_backslash_is_a_character(spark):
    from kinora.operators.serving import genre_predicate
    df = spark.createDataFrame([("a\\b",), ("ab",)], "genres string")
    assert [r.genres for r in df.where(genre_predicate("A\\B")).collect()] == ["a\\b"]
    assert df.where(genre_predicate("\\")).agg(F.count("*")).first()[0] == 1
