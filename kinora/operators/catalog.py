"""Catalogue cleaning and the transformed (serving) catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinora.functions import text
from kinora.functions.rounding import round_even

# FIXED VALUE: Bayesian prior strength (minimum-votes threshold m).
BAYES_M = 15


def clean_catalog(raw_movies: DataFrame) -> DataFrame:
    """De-duplicate by id, clean titles, de-duplicate by cleaned title, add year.

    Keep-first is made total: per id the smallest (title, genres); per cleaned
    title the smallest movie_id; NULLs come last.  Both steps are aggregations, so a hot title
    is reduced map-side before its shuffle.
    """
    by_id = (raw_movies.groupBy("movie_id")
             .agg(F.min(F.struct(F.col("title").isNull().alias("_t"), "title",
                                F.col("genres").isNull().alias("_g"), "genres")).alias("_r"))
             .select("movie_id", text.clean_title(F.col("_r.title")).alias("title"),
                     F.col("_r.genres").alias("genres")))
    by_title = (by_id.groupBy("title")
                .agg(F.min(F.struct(F.col("movie_id").isNull().alias("_m"), "movie_id",
                                   F.col("genres").isNull().alias("_g"), "genres")).alias("_r"))
                .select(F.col("_r.movie_id").alias("movie_id"), "title",
                        F.col("_r.genres").alias("genres")))
    return by_title.select("movie_id", "title", text.release_year("title").alias("release_year"),
                           "genres")


def catalog_dedup_counts(raw_movies: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: movies_initial, movies_cleaned, movies_deduplicated."""
    initial = raw_movies.agg(F.count(F.lit(1))).scalar()
    return (clean.agg(F.count(F.lit(1)).alias("movies_cleaned"))
            .select(initial.cast("bigint").alias("movies_initial"), "movies_cleaned",
                    (initial - F.col("movies_cleaned")).cast("bigint").alias("movies_deduplicated")))


def ratings_summary(known_stats: DataFrame, c, m: int = BAYES_M) -> DataFrame:
    """Per rated item: count, mean (2 dp) and Bayesian popularity (3 dp).

    popularity = v/(v+m)*R + m/(v+m)*C on the unrounded mean R.
    """
    v = F.col("rating_count")
    r = F.col("rating_sum") / v
    w = (v / (v + F.lit(m))) * r + (F.lit(m) / (v + F.lit(m))) * c
    return (known_stats.where(v > 0)
            .select("movie_id", v.cast("bigint").alias("rating_count"),
                    round_even(r, 2).alias("avg_rating"),
                    round_even(w, 3).alias("popularity_score")))


def transform_catalog(clean: DataFrame, summary: DataFrame, c) -> DataFrame:
    """Catalogue left-joined with the summary; unrated items get avg 0.0,
    count 0 and popularity round(0.5*C, 3); plus the TF-IDF feature text."""
    joined = clean.join(summary, "movie_id", "left")
    return joined.select(
        "movie_id", "title", "release_year", "genres",
        F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("popularity_score", round_even(c * F.lit(0.5), 3)).alias("popularity_score"),
        text.feature_text("title", "genres", "release_year").alias("feature_text"),
    )


def compile_genres(names: list[str], flag_prefix: str = "g_", unknown: str = "unknown"):
    """One-hot genre flags -> pipe string; the 'unknown' flag is ignored and a
    row with no other flag becomes 'Unknown'."""
    parts = [F.when(F.col(f"{flag_prefix}{i}") == 1, F.lit(n)) for i, n in enumerate(names) if n != unknown]
    joined = F.concat_ws("|", *parts)
    return F.when(joined == "", F.lit("Unknown")).otherwise(joined)
