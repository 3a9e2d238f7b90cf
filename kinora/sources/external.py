"""Landed external-metadata tables (what the metadata service would return),
projected from the driver tables so their size grows with the data.

* ``hits``    <- part (+ lineitem counts): one search hit per part
* ``details`` <- conversations: one JSON details document per conversation
* ``feed``    <- supplier + part: paged new-item feed rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.sources.fixtures import EXTERNAL_ID_OFFSET, YEAR_BASE, table


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ext_id, title, original_title, release_date, vote_count, vote_average,
    poster_path, backdrop_path, overview."""
    part = table(spark, sf_dir, "part")
    votes = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
             .agg(F.count(F.lit(1)).alias("vote_count")))
    key = F.col("p_partkey")
    year = F.lit(YEAR_BASE) + F.col("p_size") + (key % 3) - 1
    return part.join(votes, part.p_partkey == votes.l_partkey, "left").select(
        (key + EXTERNAL_ID_OFFSET).cast("bigint").alias("ext_id"),
        F.initcap(F.translate("p_name", " ", "-")).alias("title"),
        F.upper("p_name").alias("original_title"),
        F.concat(year.cast("string"), F.lit("-06-15")).alias("release_date"),
        F.coalesce("vote_count", F.lit(0)).cast("bigint").alias("vote_count"),
        (F.col("p_retailprice") % 10).cast("double").alias("vote_average"),
        F.when(key % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/p"), key.cast("string"), F.lit(".jpg"))).alias("poster_path"),
        F.when(key % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/b"), key.cast("string"), F.lit(".jpg"))).alias("backdrop_path"),
        F.concat(F.lit("About "), F.col("p_name")).alias("overview"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ext_id, details_json: overview, tagline, runtime, backdrop_path,
    credits{crew[{job,name}], cast[{name}]}, videos{results[{site,type,key}]}."""
    conv = table(spark, sf_dir, "conversations")
    turn = F.col("turn")
    job = F.when(F.col("role") == "user", F.lit("Director")).otherwise(F.lit("Producer"))
    name = F.col("text")
    entry = F.struct(
        turn.alias("turn"),
        F.struct(job.alias("job"), name.alias("name")).alias("crew"),
        F.struct(name.alias("name")).alias("cast"),
        F.struct(F.when(turn % 2 == 0, F.lit("YouTube")).otherwise(F.lit("Vimeo")).alias("site"),
                 F.when(turn % 3 == 0, F.lit("Trailer")).otherwise(F.lit("Teaser")).alias("type"),
                 F.concat(F.lit("k"), F.col("conv_id").cast("string"), F.lit("_"),
                          turn.cast("string")).alias("key")).alias("video"),
        F.length("text").alias("len"))
    g = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("t"))
    doc = F.struct(
        F.try_element_at("t", F.lit(1))["crew"]["name"].alias("overview"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("")).otherwise(F.lit("A story")).alias("tagline"),
        (F.aggregate("t", F.lit(0), lambda a, x: a + x["len"]) % 120 + 60).alias("runtime"),
        F.when(F.col("conv_id") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/d"), F.col("conv_id").cast("string"), F.lit(".jpg"))).alias("backdrop_path"),
        F.struct(F.transform("t", lambda x: x["crew"]).alias("crew"),
                 F.transform("t", lambda x: x["cast"]).alias("cast")).alias("credits"),
        F.struct(F.transform("t", lambda x: x["video"]).alias("results")).alias("videos"),
    )
    return g.select((F.col("conv_id") + EXTERNAL_ID_OFFSET).cast("bigint").alias("ext_id"),
                    F.to_json(doc).alias("details_json"))


# FIXED VALUES: genre ids used by the feed fixture, in the order of the map.
FEED_GENRE_IDS = [28, 12, 16, 35, 80, 99, 18, 10751, 14, 36, 27, 10402, 9648, 10749, 878, 10770, 53,
                  10752, 37]


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged feed rows: page, pos, title, release_date, genre_ids, vote_average.

    Suppliers are new titles (with a comma to strip); every part repeats an
    existing catalogue title (skipped by the append) and may repeat itself.
    """
    ids = F.array(*[F.lit(i) for i in FEED_GENRE_IDS])
    sup = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    s_rows = sup.select(
        (F.floor(k / 20) + 1).cast("int").alias("page"), (k % 20).cast("int").alias("pos"),
        F.regexp_replace("s_name", "#", ", No. ").alias("title"),
        F.when(k % 9 == 0, F.lit("")).otherwise(
            F.concat((F.lit(1990) + F.col("s_nationkey")).cast("string"), F.lit("-01-01"))).alias("release_date"),
        F.when(k % 11 == 0, F.array().cast("array<int>")).otherwise(
            F.array(F.try_element_at(ids, (k % 20 + 1).cast("int")),
                    F.try_element_at(ids, (k % 7 + 1).cast("int")))).alias("genre_ids"),
        ((F.col("s_acctbal") + 1000.0) / 1100.0).alias("vote_average"))
    part = table(spark, sf_dir, "part")
    j = F.col("p_partkey")
    p_rows = part.select(
        (F.floor(j / 20) + 1).cast("int").alias("page"), (F.lit(20) + j % 20).cast("int").alias("pos"),
        F.col("p_name").alias("title"),
        F.concat((F.lit(YEAR_BASE) + F.col("p_size")).cast("string"), F.lit("-05-05")).alias("release_date"),
        F.array(F.try_element_at(ids, (F.col("p_size") % 19 + 1).cast("int"))).alias("genre_ids"),
        F.lit(None).cast("double").alias("vote_average"))
    return s_rows.unionByName(p_rows)
