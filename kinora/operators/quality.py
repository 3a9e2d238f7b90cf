"""Data-quality checks over the serving tables, as violation counts.

Serving-table constraints (primary keys, NOT NULL, referential integrity) and
the invariants the reference's tests assert become one aggregate each; a
healthy build reports zero everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinora.operators.serving import ServingTables

# FIXED VALUES: keys and required columns of the serving tables.
PRIMARY_KEYS = {
    "movies": ["movie_id"],
    "ratings_summary": ["movie_id"],
    "recommendations": ["movie_id", "rank"],
    "popular_movies": ["movie_id"],
}
NOT_NULL = {
    "movies": ["movie_id", "title", "genres"],
    "ratings_summary": ["movie_id", "avg_rating", "rating_count", "popularity_score"],
    "recommendations": ["movie_id", "recommended_movie_id", "rank", "similarity_score"],
    "popular_movies": ["movie_id", "rank", "popularity_score"],
}


#: Columns that name an item of the catalogue.
REFERENCES = [("ratings_summary", "movie_id"), ("popular_movies", "movie_id"),
              ("recommendations", "movie_id"), ("recommendations", "recommended_movie_id")]


def _tagged(t: ServingTables, name: str) -> DataFrame:
    """One pass over a table: a row per primary key and per reference to an item (of
    the catalogue itself, too), with the nulls of its required columns on the first."""
    df = getattr(t, name)
    keys = [F.col(c).cast("long") for c in PRIMARY_KEYS[name]] + [F.lit(None).cast("long")]
    nulls = sum((F.col(c).isNull().cast("int") for c in NOT_NULL[name]), F.lit(0))

    def tag(what: str, first, second, missing):
        return F.struct(F.lit(what).alias("what"), first.alias("k1"), second.alias("k2"), missing.alias("nulls"))
    zero, none = F.lit(0), F.lit(None).cast("long")
    tags = [tag(f"key:{name}", keys[0], keys[1], nulls)]
    tags += [tag(f"item:{table}:{c}", F.col(c).cast("long"), none, zero) for table, c in REFERENCES if table == name]
    if name == "movies":
        tags.append(tag("item:movies", F.col("movie_id").cast("long"), none, zero))
    return df.select(F.explode(F.array(*tags)).alias("t")).select("t.*")


def dq_checks(t: ServingTables, genre_rows: DataFrame | None = None, genre: str | None = None) -> DataFrame:
    """All constraints of the four tables from one scan of each: the tagged rows are
    counted per key, where duplicates show, and per item, where references without an
    item show; a second aggregate adds both up."""
    rows = None
    for name in PRIMARY_KEYS:
        rows = _tagged(t, name) if rows is None else rows.unionByName(_tagged(t, name))
    is_key = F.col("what").startswith("key:")
    group = F.when(is_key, F.col("what")).otherwise("item")
    refs = {f"{table}:{c}": F.count_if(F.col("what") == f"item:{table}:{c}") for table, c in REFERENCES}
    per_key = rows.withColumn("what_key", group).groupBy("what_key", "k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("nulls").alias("nulls"), F.count_if(F.col("what") == "item:movies").alias("items"),
        *[c.alias(r) for r, c in refs.items()])
    orphan = (F.col("what_key") == "item") & (F.col("k1").isNull() | (F.col("items") == 0))

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")
    found = []
    for name in PRIMARY_KEYS:
        own = F.col("what_key") == f"key:{name}"
        found += [(name, "primary_key", total(own, F.col("n") - 1)), (name, "not_null", total(own, F.col("nulls")))]
    found += [(table, f"references_movies:{c}", total(orphan, F.col(f"`{table}:{c}`"))) for table, c in REFERENCES]
    out = per_key.agg(F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), v.alias("violations"))
                                for table, check, v in found]).alias("all")).select(F.explode("all").alias("r")).select("r.*")
    if genre_rows is not None and genre:
        bad = genre_rows.where(~F.lower("genres").contains(genre.lower())).agg(F.count(F.lit(1)).alias("violations"))
        out = out.unionByName(bad.select(F.lit("movies").alias("table_name"), F.lit(f"genre_filter:{genre}").alias("check_name"), "violations"))
    return out


def dq_neighbours(recs: DataFrame) -> DataFrame:
    """Score in [0, 1], no self pair, ranks 1..n without gaps, scores
    non-increasing with rank."""
    w = Window.partitionBy("movie_id").orderBy("rank")
    r = recs.withColumn("_prev", F.lag("similarity_score").over(w))
    per_src = recs.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("mx"),
                                           F.min("rank").alias("mn"))
    gaps = per_src.agg(F.count_if((F.col("mx") != F.col("n")) | (F.col("mn") != 1)).alias("v"))
    return r.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("similarity_score").between(0.0, 1.0)).alias("score_out_of_range"),
        F.count_if(F.col("movie_id") == F.col("recommended_movie_id")).alias("self_pairs"),
        F.count_if(F.col("_prev") < F.col("similarity_score")).alias("order_violations"),
    ).select("rows", "score_out_of_range", "self_pairs", "order_violations",
             gaps.scalar().alias("rank_gaps"))


def dq_popular(board: DataFrame) -> DataFrame:
    """Leaderboard read: ranks 1..n contiguous, score > 0, votes > 0."""
    return board.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max("rank") - F.count(F.lit(1))).cast("bigint").alias("rank_gap"),
        F.count_if(F.col("popularity_score") <= 0).alias("non_positive_score"),
        F.count_if(F.col("rating_count") <= 0).alias("no_votes"))
