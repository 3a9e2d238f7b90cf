"""Deterministic projections of the driver tables into this domain.

The driver ships TPC-H-like parquet tables; the catalogue/ratings domain is a
projection of them.  Each projection is written the same way in the oracle SQL
(see ``kinora.plans.oracle``) so both engines see identical inputs.

* items    <- part      : id, '{name} ({1960+size})', '{type}|{brand without #}'
* ratings  <- lineitem |><| orders : customer, part, half-star from quantity, epoch day
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# FIXED VALUES of the fixture mapping -------------------------------------------
YEAR_BASE = 1960          # release year = YEAR_BASE + p_size
EXTERNAL_ID_OFFSET = 100000
# -------------------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(col) -> "F.Column":
    """Epoch seconds of a wall-clock timestamp, independent of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, F.col(col).cast("timestamp_ntz"))


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw item rows: movie_id bigint, title string, genres string (pipe-joined)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("movie_id"),
        F.concat(F.col("p_name"), F.lit(" ("),
                 (F.lit(YEAR_BASE) + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.translate("p_brand", "#", "")).alias("genres"),
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rating rows: user_id, movie_id bigint, rating double, timestamp bigint."""
    from kinora.session import spread
    li = spread(table(spark, sf_dir, "lineitem")
                .select("l_orderkey", "l_partkey", "l_quantity", "l_tax"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    bonus = F.when((F.col("l_quantity") > 45) & (F.col("l_tax") >= 0.08), F.lit(0.5)).otherwise(F.lit(0.0))
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("movie_id"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2 + bonus).alias("rating"),
        epoch_seconds("o_orderdate").cast("bigint").alias("timestamp"),
    )


# FIXED VALUES: edge-case requests appended to the data-derived request table.
UNKNOWN_REQUEST_ID = 999999
BLANK_TITLE = "   "
NO_MATCH_TITLE = "Supercalifragilistic12345NonExistent"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request table: every part key by id, every distinct part name (upper-cased)
    by title, plus an unknown id, a blank title and a title that matches nothing."""
    part = table(spark, sf_dir, "part")
    by_id = part.select(F.col("p_partkey").cast("bigint").alias("request_id"),
                        F.lit(None).cast("string").alias("title"))
    by_title = part.select(F.lit(None).cast("bigint").alias("request_id"),
                           F.upper("p_name").alias("title")).distinct()
    edge = spark.createDataFrame(
        [(UNKNOWN_REQUEST_ID, None), (None, BLANK_TITLE), (None, NO_MATCH_TITLE)],
        "request_id bigint, title string")
    return by_id.unionByName(by_title).unionByName(edge)


def title_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles in the forms the title parser handles: plain, trailing article,
    an alternative title, and an apostrophe article with an 'a.k.a.' alias."""
    part = table(spark, sf_dir, "part")
    year = (F.lit(YEAR_BASE) + F.col("p_size")).cast("string")
    form = F.col("p_partkey") % 4
    name = F.col("p_name")
    title = (F.when(form == 1, F.concat(name, F.lit(", The ("), year, F.lit(")")))
             .when(form == 2, F.concat(name, F.lit(" ("), F.upper(name), F.lit(") ("), year, F.lit(")")))
             .when(form == 3, F.concat(name, F.lit(", L' (a.k.a. "), F.reverse(name), F.lit(") ("), year,
                                       F.lit(")")))
             .otherwise(F.concat(name, F.lit(" ("), year, F.lit(")"))))
    return part.select(F.col("p_partkey").cast("bigint").alias("movie_id"), title.alias("title"))


# FIXED VALUES of the legacy (pipe / Latin-1) item format.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
LEGACY_UNKNOWN = "unknown"


def legacy_genre_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, id): 'unknown' = 0, then the part types in name order."""
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
    # a handful of distinct types: ranking them in one window is bounded
    ranked = types.select("name", F.dense_rank().over(Window.orderBy("name")).alias("id"))
    unknown = spark.createDataFrame([(LEGACY_UNKNOWN, 0)], "name string, id int")
    return unknown.unionByName(ranked.select("name", F.col("id").cast("int")))


def legacy_items(spark: SparkSession, sf_dir: str, genre_names: list[str]) -> DataFrame:
    """Legacy item rows: id, title (every 9th without year), dd-Mon-yyyy date
    (blank for every 13th), video date, url, one 0/1 flag per genre."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    year = (F.lit(YEAR_BASE) + F.col("p_size")).cast("string")
    months = F.array(*[F.lit(m) for m in MONTHS])
    date = F.when(key % 13 == 0, F.lit("")).otherwise(F.concat(
        F.lpad((key % 28 + 1).cast("string"), 2, "0"), F.lit("-"),
        F.element_at(months, (key % 12 + 1).cast("int")), F.lit("-"), year))
    title = F.when(key % 9 == 0, F.col("p_name")).otherwise(F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")))
    second = F.lit(1) + F.col("p_size") % (len(genre_names) - 1)
    flags = []
    for i, g in enumerate(genre_names):
        if i == 0:
            flag = (key % 11 == 0)
        else:
            flag = (key % 11 != 0) & ((F.col("p_type") == g) | (second == i))
        flags.append(flag.cast("int").alias(f"g_{i}"))
    return part.select(key.cast("bigint").alias("movie_id"), title.alias("title"), date.alias("release_date"),
                       F.lit("").alias("video_release_date"),
                       F.concat(F.lit("http://example.invalid/item/"), key.cast("string")).alias("url"), *flags)
