"""Rating de-duplication, validation and per-item statistics.

Scale design.  The rating table is the only large input.  It is shuffled twice,
both times behind a map-side partial aggregate:

1. ``rating_pairs``: one row per (user, item) - keep-first copy, number of copies,
   invalid copies.  A hot pair or user collapses in the partial aggregate.
2. ``item_rating_stats``: one row per item - counts and sums of the pair rows.

Every downstream product (summary, validation and cleaning metrics, orphan
counts, the global mean) is derived from the item-level table, so joins
against the catalogue happen on one row per item, never per rating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: inclusive rating bounds.
RATING_MIN = 0.5
RATING_MAX = 5.0


def in_bounds(col) -> "F.Column":
    """Inclusive 0.5-5.0; NULL and NaN are out of bounds."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.between(RATING_MIN, RATING_MAX), F.lit(False))


def rating_pairs(raw_ratings: DataFrame) -> DataFrame:
    """(user_id, movie_id) -> kept copy + copy counts.

    Keep-first order is (timestamp, rating): ties on both carry an identical
    payload, so the kept row is fully determined.  NULLs come last.
    """
    return (raw_ratings
            .select("user_id", "movie_id", "rating", "timestamp",
                    (~in_bounds("rating")).cast("long").alias("_bad"))
            .groupBy("user_id", "movie_id")
            .agg(F.count(F.lit(1)).alias("copies"),
                 F.sum("_bad").alias("invalid_copies"),
                 F.min(F.struct(F.col("timestamp").isNull().alias("_t"), "timestamp",
                                F.col("rating").isNull().alias("_r"), "rating")).alias("_first"))
            .select("user_id", "movie_id", "copies", "invalid_copies",
                    F.col("_first.rating").alias("rating"),
                    F.col("_first.timestamp").alias("timestamp"),
                    in_bounds(F.col("_first.rating")).alias("valid")))


def item_rating_stats(pairs: DataFrame) -> DataFrame:
    """Item-level counts: raw rows, pairs, invalid raw rows, valid kept ratings."""
    return (pairs.groupBy("movie_id")
            .agg(F.sum("copies").alias("raw_rows"),
                 F.count(F.lit(1)).alias("pairs"),
                 F.sum("invalid_copies").alias("raw_invalid"),
                 F.sum(F.col("valid").cast("long")).alias("rating_count"),
                 F.sum(F.when(F.col("valid"), F.col("rating"))).alias("rating_sum")))


def clean_ratings(pairs: DataFrame, clean_movies: DataFrame) -> DataFrame:
    """Row-level cleaned ratings: de-duplicated, in bounds, known item."""
    known = clean_movies.select("movie_id")
    return (pairs.where("valid")
            .join(known, "movie_id", "left_semi")
            .select("user_id", "movie_id", "rating", "timestamp"))


def known_item_stats(stats: DataFrame, clean_movies: DataFrame) -> DataFrame:
    """Item stats restricted to the cleaned catalogue (semi join on items)."""
    return stats.join(clean_movies.select("movie_id"), "movie_id", "left_semi")


def global_mean(known_stats: DataFrame):
    """Mean of all cleaned ratings as a scalar-subquery Column."""
    return (known_stats.agg((F.sum("rating_sum") / F.sum("rating_count")).alias("c"))
            .scalar())


def rating_histogram(pairs: DataFrame, clean_movies: DataFrame) -> DataFrame:
    """Half-star histogram of cleaned ratings with share and ratio to max.

    Counted per (item, rating) first so the catalogue semi join sees one row
    per item and rating level, then summed per level.
    """
    per_item = (pairs.where("valid").groupBy("movie_id", "rating").agg(F.count(F.lit(1)).alias("n"))
                .join(clean_movies.select("movie_id"), "movie_id", "left_semi"))
    hist = per_item.groupBy("rating").agg(F.sum("n").cast("bigint").alias("count"))
    total = hist.agg(F.sum("count")).scalar()
    top = hist.agg(F.max("count")).scalar()
    from kinora.functions.rounding import round_half_up
    return hist.select(
        "rating", "count",
        round_half_up((F.col("count") / total) * 100.0, 1).alias("pct"),
        (F.col("count") / top).alias("ratio_to_max"))
