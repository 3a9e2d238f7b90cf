"""Append a landed new-item feed to the catalogue, with seed ratings.

Feed rows arrive in pages; the reference walks pages in order, stops at the
first empty page, skips titles it already has (including ones added earlier in
the same run), numbers new items consecutively and adds ten ratings per item
from a fixed user range.

Spark form: page cut-off and keep-first are aggregations / anti joins; ids use
``consecutive_ids`` (per-partition counts -> prefix offsets -> local index),
so no global window pulls the feed into one task; the user range is an
``explode(sequence)``; the rating noise is a deterministic hash of
(item, user), so a retried task writes the same values.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinora.functions import text
from kinora.session import materialize

# FIXED VALUES ------------------------------------------------------------------
FIRST_NEW_ID = 600000
SEED_USERS = (900, 910)              # users 900..909 rate every new item
NO_GENRES = "(no genres listed)"
UNKNOWN_GENRE = "Unknown"
DEFAULT_VOTE = 5.0
# Genre id -> name map of the external service (fallback list of the reference).
GENRE_MAP = {
    28: "Action", 12: "Adventure", 16: "Animation", 35: "Comedy", 80: "Crime",
    99: "Documentary", 18: "Drama", 10751: "Family", 14: "Fantasy", 36: "History",
    27: "Horror", 10402: "Music", 9648: "Mystery", 10749: "Romance", 878: "Sci-Fi",
    10770: "TV Movie", 53: "Thriller", 10752: "War", 37: "Western",
}
# -------------------------------------------------------------------------------


def genre_map_column() -> Column:
    return F.create_map(*[x for k, v in GENRE_MAP.items() for x in (F.lit(k), F.lit(v))])


def consecutive_ids(df: DataFrame, order: list[str], start: int | Column, id_col: str) -> DataFrame:
    """Number rows start, start+1, ... in ``order`` without a global window.

    Rows are range-partitioned, sorted on ``order`` and written once with their
    partition and place in it: the bounds of a range exchange are sampled, so
    counts and rows must come from the same one.  Each partition's row count
    (one row per partition) gives prefix offsets; a row's id is its partition
    offset plus its place.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition id << 33) + index within partition
    ranged = ranged.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    ranged = materialize(ranged.drop("_mid"), "numbered")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    # one row per partition: a bounded broadcast
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (start + F.col("_off") + F.col("_local")).cast("bigint")).drop(
        "_pid", "_local", "_off")


def first_unreachable(passable: DataFrame, start: int = 1) -> Column:
    """The first page from ``start`` on that is not among ``passable(page)``, as a scalar:
    pages are walked in order and the walk ends there."""
    spark = passable.sparkSession
    held = passable.where(F.col("page") >= start).select(F.col("page").cast("int").alias("page")).distinct()
    after = held.select((F.col("page") + 1).alias("page")).unionByName(
        spark.range(1).select(F.lit(start).cast("int").alias("page")))
    return after.join(held, "page", "left_anti").agg(F.min("page")).scalar()


def accepted_feed(feed: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Rows of the pages from 1 up to (excluding) the first missing or empty page, of
    the first ``max_pages`` if a limit is wanted."""
    wanted = F.col("page") >= 1 if max_pages is None else F.col("page").between(1, max_pages)
    return feed.where((F.col("page") >= 1) & (F.col("page") < first_unreachable(feed.where(wanted).select("page"))))


def new_items(feed: DataFrame, existing: DataFrame, max_pages: int | None = None) -> DataFrame:
    """feed(page, pos, title, release_date, genre_ids, vote_average) ->
    (movie_id, title, genres, seed_rating) for titles not seen before.

    Ids start after the largest ``movie_id`` of ``existing(title[, movie_id])``,
    at FIRST_NEW_ID at least."""
    return fresh_items(accepted_feed(feed, max_pages), existing)


def fresh_items(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """``new_items`` of feed rows that are all to be taken."""
    start = F.lit(FIRST_NEW_ID).cast("bigint")
    if "movie_id" in existing.columns:
        start = F.greatest(start, F.coalesce(existing.agg(F.max("movie_id") + 1).scalar(), start))
    rows = rows.select(
        "page", "pos", text.compose_title("title", "release_date").alias("full_title"),
        "genre_ids", "vote_average")
    first = (rows.groupBy("full_title")
             .agg(F.min(F.struct("page", "pos", "genre_ids", "vote_average")).alias("_r"))
             .select("full_title", "_r.*"))
    fresh = first.join(existing.select(F.col("title").alias("full_title")).distinct(),
                       "full_title", "left_anti")
    names = F.transform(F.coalesce("genre_ids", F.array().cast("array<int>")),
                        lambda g: F.coalesce(genre_map_column()[g], F.lit(UNKNOWN_GENRE)))
    genres = F.when(F.size(names) > 0, F.array_join(names, "|")).otherwise(F.lit(NO_GENRES))
    vote = F.coalesce(F.col("vote_average"), F.lit(DEFAULT_VOTE))
    seed = F.greatest(F.lit(0.5), F.least(F.lit(5.0), F.rint((vote / 2) * 2) / 2))
    items = fresh.select("page", "pos", F.col("full_title").alias("title"), genres.alias("genres"),
                         seed.alias("seed_rating"))
    return consecutive_ids(items, ["page", "pos"], start, "movie_id").select(
        "movie_id", "title", "genres", "seed_rating")


def run_stamp(at: float | None = None) -> Column:
    """The time of a run in whole seconds, read once on the driver: all its rows, and
    those of a task that runs again, carry the same stamp."""
    return F.lit(int(time.time() if at is None else at)).cast("bigint")


def seed_ratings(items: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Ten ratings per new item: seed rating plus noise in {-0.5, 0, +0.5}, clamped; the
    stamp is the run's time unless given."""
    timestamp = run_stamp() if timestamp is None else timestamp
    users = F.explode(F.sequence(F.lit(SEED_USERS[0]), F.lit(SEED_USERS[1] - 1)))
    r = (items.select("movie_id", "seed_rating", users.alias("user_id"))
         .withColumn("user_id", F.col("user_id").cast("bigint")))
    noise = (F.pmod(F.col("movie_id") * 31 + F.col("user_id"), F.lit(3)) - 1).cast("double") * 0.5
    rating = F.greatest(F.lit(0.5), F.least(F.lit(5.0), F.col("seed_rating") + noise))
    return r.select("user_id", "movie_id", rating.alias("rating"), timestamp.cast("bigint").alias("timestamp"))
