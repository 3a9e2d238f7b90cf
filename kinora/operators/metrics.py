"""Validation, cleaning and pipeline metrics as one-row DataFrames.

All counts come from the item-level rating table (one row per item), plus the
catalogue; nothing is counted by iterating on the driver.  Scalars are
combined as scalar subqueries over a one-row anchor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _one_row(spark: SparkSession, **cols) -> DataFrame:
    return spark.range(1).select(*[c.cast("bigint").alias(n) for n, c in cols.items()])


def _stats(df: DataFrame, **aggs):
    """All aggregates of one table as a single struct-valued scalar subquery,
    so each table is scanned once per metrics frame (identical subqueries are
    reused across frames)."""
    return df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()


def _total(col: str):
    return F.coalesce(F.sum(col), F.lit(0))


def _item_totals(item_stats: DataFrame):
    return _stats(item_stats, rows=_total("raw_rows"), pairs=_total("pairs"),
                  invalid=_total("raw_invalid"), valid=_total("rating_count"))


def validate_raw(spark: SparkSession, raw_movies: DataFrame, item_stats: DataFrame) -> DataFrame:
    """Row counts, duplicate ids/pairs, out-of-range and orphan ratings (raw)."""
    orphans = item_stats.join(raw_movies.select("movie_id"), "movie_id", "left_anti")
    movies = _stats(raw_movies, n=F.count(F.lit(1)), distinct=F.count_distinct("movie_id"))
    items = _item_totals(item_stats)
    return _one_row(
        spark,
        raw_movie_count=movies["n"],
        raw_rating_count=items["rows"],
        duplicate_movies=movies["n"] - movies["distinct"],
        duplicate_ratings=items["rows"] - items["pairs"],
        invalid_ratings=items["invalid"],
        orphan_ratings=_stats(orphans, rows=_total("raw_rows"))["rows"],
        user_count=F.lit(0),
    )


def cleaning_metrics(spark: SparkSession, raw_movies: DataFrame, clean_movies: DataFrame,
                     item_stats: DataFrame, known_stats: DataFrame) -> DataFrame:
    """initial / deduplicated / invalid / orphan / final counts for both tables."""
    items = _item_totals(item_stats)
    cleaned = _stats(known_stats, valid=_total("rating_count"))["valid"]
    movies_initial = _stats(raw_movies, n=F.count(F.lit(1)))["n"]
    movies_cleaned = _stats(clean_movies, n=F.count(F.lit(1)))["n"]
    return _one_row(
        spark,
        movies_initial=movies_initial,
        movies_cleaned=movies_cleaned,
        movies_deduplicated=movies_initial - movies_cleaned,
        ratings_initial=items["rows"],
        ratings_cleaned=cleaned,
        ratings_deduplicated=items["rows"] - items["pairs"],
        ratings_invalid_dropped=items["pairs"] - items["valid"],
        ratings_orphans_dropped=items["valid"] - cleaned,
    )
