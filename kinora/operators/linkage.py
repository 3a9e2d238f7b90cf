"""Record linkage of catalogue items to an external metadata table, and the
incremental enrichment job built on it.

Matching rules (the reference's):

* search names: parsed title candidates (article moved, alternatives, unique)
* the search service returns at most 10 hits per (name[, year]) query, best
  known first (here: votes desc, id asc), matched on the normalised name
* score: +10 when any candidate's normalised name equals the hit's normalised
  title or original title; year difference 0 / 1 / more -> +6 / +3 / -5 when
  both years are known; + min(votes, 5000) / 1000; -3 without a poster
* pass 1: candidates searched with the year; best hit accepted at score >= 12
* pass 2 (items not accepted): add year-free hits of the first 2 candidates to
  the pool; best hit accepted at score > 0.  Ties: smaller external id.

Scale: search result lists are computed once per query key (not per item)
with a salted two-stage top-10, so a name shared by a third of all hits is
split over many tasks; items then join their <= 10-row result lists on the
key.  No pair of items is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinora.functions import text

# FIXED VALUES
HITS_PER_QUERY = 10
ACCEPT_FIRST_PASS = 12.0
VOTE_CAP = 5000
SECOND_PASS_CANDIDATES = 2
CAST_LIMIT = 8


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int,
                  salt_col: str, buckets: int | None = None) -> DataFrame:
    """Exact top-n per key in two window stages: within (key, salt), then within key.
    A hot key is spread over ``buckets`` tasks (the shuffle width, unless given);
    stage 2 sees <= n * buckets rows."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(salt_col), F.lit(buckets))
    s1 = (df.withColumn("_salt", salt)
          .withColumn("_r1", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
          .where(F.col("_r1") <= n).drop("_r1", "_salt"))
    return (s1.withColumn("_r2", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .where(F.col("_r2") <= n).drop("_r2"))


def search_index(hits: DataFrame) -> DataFrame:
    """(key, ext_id, hit_year, votes): a hit is findable by either normalised name."""
    keys = F.array_distinct(F.array(text.link_key("title"), text.link_key("original_title")))
    return hits.select(F.explode(keys).alias("key"), "ext_id",
                       text.year_from_date("release_date").alias("hit_year"),
                       F.col("vote_count").alias("votes")).where("key <> ''")


def search_results(hits: DataFrame, with_year: bool) -> DataFrame:
    idx = search_index(hits)
    order = [F.col("votes").desc(), F.col("ext_id").asc()]
    if with_year:
        idx = idx.where(F.col("hit_year").isNotNull())
        return top_n_per_key(idx, ["key", "hit_year"], order, HITS_PER_QUERY, "ext_id").select(
            "key", F.col("hit_year").alias("year"), "ext_id")
    return top_n_per_key(idx, ["key"], order, HITS_PER_QUERY, "ext_id").select("key", "ext_id")


def named(items: DataFrame) -> DataFrame:
    """(movie_id, title, year, candidates) of items(movie_id, title, release_year)."""
    parsed = text.parse_title("title")
    return items.select(
        "movie_id", "title",
        F.coalesce(F.when(F.col("release_year") != 0, F.col("release_year")), parsed["year"]).alias("year"),
        parsed["candidates"].alias("candidates"))


def searches(items: DataFrame) -> DataFrame:
    """One row per search name of an item, with its place among them and its key."""
    cands = named(items).select("movie_id", "title", "year", "candidates",
                                F.posexplode("candidates").alias("cpos", "cand"))
    return cands.withColumn("key", text.link_key("cand")).where("key <> ''")


def link_items(items: DataFrame, hits: DataFrame, results: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """items(movie_id, title, release_year) -> (movie_id, ext_id, score, pass)
    for items with an accepted hit.  ``results`` are the search results with and without
    the year where they are stored."""
    base, cands = named(items), searches(items)
    dated, free = results or (search_results(hits, True), search_results(hits, False))

    pool1 = (cands.where(F.col("year").isNotNull())
             .join(dated, ["key", "year"])
             .select("movie_id", "ext_id").distinct())
    scored1 = _score(pool1, base, hits)
    best1 = _best(scored1)
    accepted1 = best1.where(F.col("score") >= ACCEPT_FIRST_PASS).withColumn("pass", F.lit(1))

    pending = base.join(accepted1.select("movie_id"), "movie_id", "left_anti").select("movie_id")
    extra = (cands.where(F.col("cpos") < SECOND_PASS_CANDIDATES)
             .join(pending, "movie_id", "left_semi")
             .join(free, "key")
             .select("movie_id", "ext_id"))
    pool2 = pool1.join(pending, "movie_id", "left_semi").unionByName(extra).distinct()
    best2 = _best(_score(pool2, base, hits))
    accepted2 = best2.where(F.col("score") > 0).withColumn("pass", F.lit(2))
    return accepted1.unionByName(accepted2)


def _score(pool: DataFrame, base: DataFrame, hits: DataFrame) -> DataFrame:
    h = hits.select("ext_id", text.link_key("title").alias("nt"),
                    text.link_key("original_title").alias("no"),
                    text.year_from_date("release_date").alias("hit_year"),
                    "vote_count", "poster_path")
    j = pool.join(base.select("movie_id", "year", "candidates"), "movie_id").join(h, "ext_id")
    name_hit = F.exists("candidates", lambda c: (text.link_key(c) != "") & ((text.link_key(c) == F.col("nt"))
                        | (text.link_key(c) == F.col("no"))))
    diff = F.abs(F.col("hit_year") - F.col("year"))
    year_part = (F.when(F.col("year").isNull() | F.col("hit_year").isNull(), F.lit(0.0))
                 .when(diff == 0, F.lit(6.0)).when(diff == 1, F.lit(3.0)).otherwise(F.lit(-5.0)))
    score = (F.when(name_hit, F.lit(10.0)).otherwise(F.lit(0.0)) + year_part
             + F.least(F.col("vote_count"), F.lit(VOTE_CAP)) / F.lit(1000.0)
             - F.when(F.coalesce(F.col("poster_path"), F.lit("")) == "", F.lit(3.0)).otherwise(F.lit(0.0)))
    return j.select("movie_id", "ext_id", score.alias("score"))


def _best(scored: DataFrame) -> DataFrame:
    w = Window.partitionBy("movie_id").orderBy(F.col("score").desc(), F.col("ext_id").asc())
    return scored.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


# -- nested details (C21) ----------------------------------------------------------
DETAILS_SCHEMA = (
    "overview string, tagline string, runtime int, backdrop_path string, "
    "credits struct<crew: array<struct<job: string, name: string>>, cast: array<struct<name: string>>>, "
    "videos struct<results: array<struct<site: string, type: string, key: string>>>")


def _nz(c: Column) -> Column:
    """Python truthiness for strings: '' counts as missing."""
    return F.when(c != "", c)


def enrich_records(items: DataFrame, links: DataFrame, hits: DataFrame, details: DataFrame) -> DataFrame:
    """One record per item; items without an accepted hit get found = false."""
    d = details.select("ext_id", F.from_json("details_json", DETAILS_SCHEMA).alias("d"))
    crew, cast = F.col("d.credits.crew"), F.col("d.credits.cast")
    vids = F.col("d.videos.results")
    yt = F.filter(vids, lambda v: v["site"] == "YouTube")
    first = lambda arr: F.try_element_at(arr, F.lit(1))  # noqa: E731 - NULL when empty
    trailer = F.coalesce(first(F.filter(yt, lambda v: v["type"] == "Trailer"))["key"], first(yt)["key"])
    director = first(F.filter(crew, lambda c: c["job"] == "Director"))["name"]
    h = hits.select("ext_id", F.col("title").alias("meta_title"), "poster_path",
                    F.col("backdrop_path").alias("hit_backdrop"), F.col("overview").alias("hit_overview"),
                    F.col("vote_average").alias("meta_rating"))
    matched = links.select("movie_id", "ext_id").join(h, "ext_id").join(d, "ext_id", "left")
    rec = matched.select(
        "movie_id", F.lit(True).alias("found"), F.col("ext_id").alias("meta_id"), "meta_title",
        "poster_path",
        F.coalesce(_nz(F.col("hit_backdrop")), _nz(F.col("d.backdrop_path"))).alias("backdrop_path"),
        F.coalesce(_nz(F.col("d.overview")), _nz(F.col("hit_overview")), F.lit("")).alias("overview"),
        F.coalesce(_nz(F.col("d.tagline")), F.lit("")).alias("tagline"),
        F.col("d.runtime").alias("runtime"), "meta_rating",
        F.coalesce(director, F.lit("")).alias("director"),
        F.coalesce(F.slice(F.transform(cast, lambda c: c["name"]), 1, CAST_LIMIT),
                   F.array().cast("array<string>")).alias("cast"),
        trailer.alias("trailer_key"))
    missing = items.select("movie_id").join(links.select("movie_id"), "movie_id", "left_anti")
    nulls = [F.lit(None).cast(rec.schema[c].dataType).alias(c) for c in rec.columns[2:]]
    return rec.unionByName(missing.select("movie_id", F.lit(False).alias("found"), *nulls))


def enrich_todo(items: DataFrame, cache: DataFrame, refresh: bool = False) -> DataFrame:
    """Items not yet in the cache (all items when refreshing)."""
    if refresh:
        return items
    return items.join(cache.select("movie_id"), "movie_id", "left_anti")


def cache_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two keyed record sets; the newer side wins per movie_id."""
    both = (old.withColumn("_prio", F.lit(0)).unionByName(new.withColumn("_prio", F.lit(1))))
    w = Window.partitionBy("movie_id").orderBy(F.col("_prio").desc())
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_prio")


def coverage(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Share of catalogue items whose cached record was found (1 decimal)."""
    found = cache.where("found").select("movie_id").join(items.select("movie_id"), "movie_id", "left_semi")
    n_found = found.agg(F.count(F.lit(1))).scalar()
    return items.agg(F.count(F.lit(1)).alias("catalog_count")).select(
        "catalog_count", n_found.alias("found_count"),
        (F.rint(F.lit(100.0) * n_found / F.col("catalog_count") * 10) / 10).alias("coverage_pct"))
