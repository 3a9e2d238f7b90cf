"""Batch recommendation products over the serving tables.

* ``search_batch`` / ``resolve_titles``: ranked title search for a whole table
  of queries.  ``title ILIKE '%q%'`` is a theta predicate; instead of a nested
  loop join, candidates come from an equi-join on a character n-gram index:
  every lower-cased literal run of the query is a substring of the matching
  title, so each title candidate shares the query's *rarest* gram.  The exact
  ILIKE predicate then verifies each candidate.  The index is a stored serving
  table (``TitleIndex``), built once per catalogue and read by every search.
* ``recommend``: stored neighbours per requested item; items with no stored
  neighbour at all get the popularity list (minus the item, re-ranked).  The
  popular list is bounded (top_k + 1 rows) and reaches every request row as a
  literal array - no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinora.functions.text import strip_ws
from kinora.operators.serving import (MOVIE_COLS, SEARCH_LIMIT_DEFAULT, SEARCH_LIMIT_MAX,
                                      TOP_K_DEFAULT, TOP_K_MAX, ServingTables, _check)
from kinora.session import materialize

# FIXED VALUES
GRAM = 3                                  # n-gram size of the title index
SIMILARITY_METHOD = "TF-IDF N-Gram Vectorization + Cosine Similarity"
SEGMENT_PER_LIST = 15                     # rows shown per segment
MATCH_ALL = ""                            # probe gram of a query made of wildcards only
POSTINGS = 4096                           # titles in a chunk of a gram's postings, about

REC_COLS = ["rank", "movie_id", "title", "genres", "release_year", "avg_rating",
            "rating_count", "popularity_score", "similarity_score"]


def _grams(s: Column, n: int) -> Column:
    length = F.length(s)
    return F.when(length >= n, F.transform(F.sequence(F.lit(1), length - n + 1),
                                           lambda i: F.substring(s, i, n))
                  ).otherwise(F.array().cast("array<string>"))


def title_gram_index(movies: DataFrame) -> DataFrame:
    """(movie_id, gram): distinct 1-, 2- and 3-grams of the lower-cased title,
    plus the match-all gram."""
    low = F.lower(F.col("title"))
    grams = F.array_distinct(F.concat(*[_grams(low, n) for n in range(1, GRAM + 1)],
                                      F.array(F.lit(MATCH_ALL))))
    return movies.select("movie_id", F.explode(grams).alias("gram"))


class TitleIndex:
    """The stored index of the title search.

    ``postings`` (gram, chunk, n, ids) holds a gram's titles, files sorted by gram so that
    a read skips pages of others, in chunks of about ``POSTINGS`` titles at most: no gram,
    the match-all one included, makes a row that grows with the catalogue.  ``grams``
    (gram, df: in how many titles it occurs) reads two narrow columns of it.
    """

    def __init__(self, t: ServingTables, postings: int | None = None):
        chunks = F.greatest(F.lit(1), t.movies.agg(F.ceil(F.count(F.lit(1)) / (postings or POSTINGS))).scalar())
        posted = (title_gram_index(t.movies).groupBy("gram", F.pmod(F.xxhash64("movie_id"), chunks).alias("chunk"))
                  .agg(F.count(F.lit(1)).alias("n"), F.collect_list("movie_id").alias("ids")))
        self.postings = materialize(posted.sortWithinPartitions("gram", "chunk"), "title-postings")
        self.grams = self.postings.groupBy("gram").agg(F.sum("n").alias("df"))


def _query_grams(q: Column) -> Column:
    """Grams every matching title must contain: grams of each literal run."""
    runs = F.filter(F.split(F.lower(q), "[%_]"), lambda x: x != "")
    per_run = F.transform(runs, lambda r: F.when(F.length(r) >= GRAM, _grams(r, GRAM))
                          .otherwise(F.array(r)))
    flat = F.array_distinct(F.flatten(per_run))
    return F.when(F.size(flat) > 0, flat).otherwise(F.array(F.lit(MATCH_ALL)))


def search_batch(t: ServingTables, queries: DataFrame, limit: int = SEARCH_LIMIT_DEFAULT) -> DataFrame:
    """queries(query_id, query) -> top ``limit`` matches per query, ranked
    exact / prefix / contains, then popularity (NULL last), then id."""
    _check("limit", limit, 1, SEARCH_LIMIT_MAX)
    qs = (queries.select("query_id", strip_ws("query").alias("q"))
          .where(F.col("q") != ""))
    index = t.search_index(TitleIndex)
    probe = (qs.select("query_id", "q", F.explode(_query_grams(F.col("q"))).alias("gram"))
             .join(index.grams, "gram")   # a gram no title has: the query matches nothing
             .withColumn("_r", F.row_number().over(
                 Window.partitionBy("query_id").orderBy("df", "gram")))
             .where("_r = 1").select("query_id", "q", "gram"))
    details = t.movies.select(*MOVIE_COLS).join(t.ratings_summary, "movie_id", "left")
    cands = (probe.join(index.postings, "gram").select("query_id", "q", F.explode("ids").alias("movie_id"))
             .join(details, "movie_id")
             .withColumn("_like", F.replace(F.col("q"), F.lit("\\"), F.lit("\\\\")))  # no escape character
             .where(F.expr("title ILIKE concat('%', _like, '%')")))
    lt, lq = F.lower(F.col("title")), F.lower(F.col("q"))
    rel = F.when(lt == lq, 1).when(F.expr("lower(title) LIKE concat(lower(_like), '%')"), 2).otherwise(3)
    w = Window.partitionBy("query_id").orderBy(rel, F.col("popularity_score").desc_nulls_last(),
                                               F.col("movie_id"))
    ranked = cands.withColumn("position", F.row_number().over(w).cast("int")).where(
        F.col("position") <= limit)
    return ranked.select("query_id", "position", *MOVIE_COLS,
                         F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
                         F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
                         F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score"))


def resolve_titles(t: ServingTables, queries: DataFrame) -> DataFrame:
    """queries(query_id, query) -> (query_id, movie_id) best match, if any."""
    return search_batch(t, queries, 1).select("query_id", "movie_id", "title")


POOL_FIELDS = ["rank", *MOVIE_COLS, "avg_rating", "rating_count", "popularity_score"]


def _popular_array(t: ServingTables, n: int) -> Column:
    """The first n leaderboard rows with details as a literal array.

    n <= TOP_K_MAX + 1, so at most 101 rows ever leave the cluster; as a literal the list
    reaches every request row without a join.  (As a scalar subquery it breaks the analysis
    of later joins of the result with the tables it was made from.)
    """
    p = t.popular_movies.select("movie_id", "rank", "popularity_score")
    s = t.ratings_summary.select("movie_id", "avg_rating", "rating_count")
    rows = (p.join(t.movies.select(*MOVIE_COLS), "movie_id").join(s, "movie_id")
            .orderBy("rank").limit(n).select(*POOL_FIELDS))
    schema = rows.schema
    items = rows.collect()
    if not items:
        return F.array().cast(T.ArrayType(T.StructType(schema.fields)))
    return F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])
                     for r in sorted(items, key=lambda r: r["rank"])])


def recommend(t: ServingTables, requests: DataFrame, top_k: int = TOP_K_DEFAULT,
              include_not_found: bool = True) -> DataFrame:
    """requests(request_id, movie_id) -> recommendation rows with a status:
    'ok' (stored neighbours), 'fallback' (no stored neighbour: popular items,
    the source excluded, re-ranked, similarity 0.0), 'not_found' or 'rejected'.

    A ``top_k`` column of the requests, where there is one, asks for each request's own
    number of rows, a null there for ``top_k``; a number outside 1 to TOP_K_MAX is rejected."""
    _check("top_k", top_k, 1, TOP_K_MAX)
    own_k = "top_k" in requests.columns
    reqs = requests.select("request_id", F.col("movie_id").alias("source_id"),
                           (F.coalesce(F.col("top_k").cast("int"), F.lit(top_k)) if own_k else F.lit(top_k)).alias("_k"))
    refused = reqs.where(~F.col("_k").between(1, TOP_K_MAX))
    if own_k:
        reqs, top_k = reqs.where(F.col("_k").between(1, TOP_K_MAX)), TOP_K_MAX
    movies = t.movies.select(*MOVIE_COLS)
    known = reqs.join(movies.select(F.col("movie_id").alias("source_id")), "source_id", "left_semi")
    missing = reqs.join(movies.select(F.col("movie_id").alias("source_id")), "source_id", "left_anti")

    recs = t.recommendations.where(F.col("rank") <= top_k).select(
        F.col("movie_id").alias("source_id"), F.col("recommended_movie_id").alias("movie_id"),
        "rank", "similarity_score")
    details = movies.join(t.ratings_summary, "movie_id", "left").select(
        *MOVIE_COLS, F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
        F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score"))
    ok = (known.join(recs, "source_id").where(F.col("rank") <= F.col("_k")).join(details, "movie_id")
          .select("request_id", "source_id", F.lit("ok").alias("status"),
                  F.lit(False).alias("is_fallback"), *REC_COLS))

    # Ranks start at 1, so this is one row a source.
    sources_with_recs = t.recommendations.where("rank = 1").select(F.col("movie_id").alias("source_id"))
    lonely = known.join(sources_with_recs, "source_id", "left_anti")
    picked = F.slice(F.filter("_pool", lambda x: x["movie_id"] != F.col("source_id")), F.lit(1), F.col("_k"))
    fb = (lonely.withColumn("_pool", _popular_array(t, top_k + 1))
          .select("request_id", "source_id", F.posexplode(picked).alias("pos", "r"))
          .select("request_id", "source_id", F.lit("fallback").alias("status"),
                  F.lit(True).alias("is_fallback"), (F.col("pos") + 1).cast("int").alias("rank"),
                  *[F.col(f"r.{c}").alias(c) for c in REC_COLS[1:-1]],
                  F.lit(0.0).alias("similarity_score")))

    if not include_not_found:
        return ok.unionByName(fb)

    def without_rows(df: DataFrame, status: str) -> DataFrame:
        return df.select("request_id", "source_id", F.lit(status).alias("status"), F.lit(False).alias("is_fallback"),
                         *[F.lit(None).cast(ok.schema[c].dataType).alias(c) for c in REC_COLS])
    rows = ok.unionByName(fb).unionByName(without_rows(missing, "not_found"))
    return rows.unionByName(without_rows(refused, "rejected")) if own_k else rows


#: Why a request has the rows it has, by status.
REASONS = {"ok": "similar items", "fallback": "no similar items: popular items instead", "not_found": "unknown item",
           "no_match": "no title matches", "rejected": "neither id nor title, or top_k out of range"}


def summarise(recs: DataFrame, key: str = "request_id") -> DataFrame:
    """Per request of ``recommend`` or ``recommend_by_request``: status, fallback flag,
    reason and the number of rows."""
    reason = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return (recs.groupBy(key, "status", "is_fallback").agg(F.count("movie_id").alias("result_count"))
            .withColumn("reason", reason[F.col("status")]))


def similar_breakdown(t: ServingTables, requests: DataFrame, limit: int = 5) -> DataFrame:
    """Per known source: method label and its first ``limit`` recommendations."""
    _check("limit", limit, 1, 20)
    recs = recommend(t, requests, limit, include_not_found=False)
    src = t.movies.select(F.col("movie_id").alias("source_id"), F.col("title").alias("source_title"),
                          F.col("genres").alias("source_genres"))
    return recs.join(src, "source_id").select(
        "request_id", "source_id", "source_title", "source_genres",
        F.lit(SIMILARITY_METHOD).alias("similarity_method"), "rank",
        F.col("movie_id").alias("recommended_movie_id"), "title", "genres", "similarity_score",
        "avg_rating")


def recommend_by_request(t: ServingTables, requests: DataFrame, top_k: int = TOP_K_DEFAULT) -> DataFrame:
    """requests(request_key, request_id, title): by id when given, else by the
    best title match.  Status 'rejected' (neither given, or a ``top_k`` column of the
    requests is out of range there), 'no_match' (title matches nothing), else as
    ``recommend``, with each request's own ``top_k`` where there is one."""
    own_k = ["top_k"] if "top_k" in requests.columns else []
    reqs = requests.select("request_key", "request_id", "title", *own_k)
    in_range = F.coalesce(F.col("top_k").between(1, TOP_K_MAX), F.lit(True)) if own_k else F.lit(True)
    out_of_range = reqs.where(~in_range)
    reqs = reqs.where(in_range)
    by_title = reqs.where(F.col("request_id").isNull())
    blank = F.coalesce(strip_ws("title"), F.lit("")) == ""
    rejected = by_title.where(blank)
    resolved = resolve_titles(t, by_title.where(~blank).select(
        F.col("request_key").alias("query_id"), F.col("title").alias("query")))
    to_search = by_title.where(~blank)
    matched = to_search.join(resolved.select(F.col("query_id").alias("request_key"),
                                             F.col("movie_id").alias("resolved_id")),
                             "request_key", "left")
    targets = (reqs.where(F.col("request_id").isNotNull())
               .select("request_key", F.col("request_id").alias("movie_id"), *own_k)
               .unionByName(matched.where(F.col("resolved_id").isNotNull())
                            .select("request_key", F.col("resolved_id").alias("movie_id"), *own_k)))
    recs = recommend(t, targets.withColumnRenamed("request_key", "request_id"), top_k)
    recs = recs.withColumnRenamed("request_id", "request_key")
    empty = [F.lit(None).cast(recs.schema[c].dataType).alias(c) for c in REC_COLS]
    no_match = matched.where(F.col("resolved_id").isNull()).select(
        "request_key", F.lit(None).cast("bigint").alias("source_id"), F.lit("no_match").alias("status"),
        F.lit(False).alias("is_fallback"), *empty)
    rej = rejected.unionByName(out_of_range).select("request_key", F.lit(None).cast("bigint").alias("source_id"),
                          F.lit("rejected").alias("status"), F.lit(False).alias("is_fallback"), *empty)
    return recs.unionByName(no_match).unionByName(rej)


def validate_requests(requests: DataFrame) -> DataFrame:
    """The requests with ``valid`` and a ``reason``, by the rules of ``recommend_by_request``."""
    missing = F.col("request_id").isNull() & (F.coalesce(strip_ws("title"), F.lit("")) == "")
    reason = (F.when(missing, F.lit("missing_id_and_title"))
              .when(~F.col("top_k").between(1, TOP_K_MAX), F.lit("top_k_out_of_range")).otherwise(F.lit("ok")))
    return requests.withColumn("reason", reason).withColumn("valid", F.col("reason") == "ok")


def serve_neighbours(t: ServingTables, k: int = 5) -> DataFrame:
    """Sanity read for every source: first k stored neighbours with details
    (inner join to items, left join to the summary)."""
    r = t.recommendations.where(F.col("rank") <= k)
    m = t.movies.select(*MOVIE_COLS)
    s = t.ratings_summary.select("movie_id", "avg_rating")
    return (r.select(F.col("movie_id").alias("source_id"), F.col("recommended_movie_id").alias("movie_id"),
                     "rank", "similarity_score")
            .join(m, "movie_id").join(s, "movie_id", "left")
            .select("source_id", "rank", "movie_id", "title", "genres", "avg_rating", "similarity_score"))


def segment_topk(t: ServingTables, requests: DataFrame, threshold: int,
                 fetch: int = TOP_K_MAX, per_segment: int = SEGMENT_PER_LIST) -> DataFrame:
    """Split each source's first ``fetch`` recommendations at an id threshold
    and keep the first ``per_segment`` of each side, order kept."""
    recs = recommend(t, requests, fetch, include_not_found=False)
    seg = F.when(F.col("movie_id") >= threshold, F.lit("high")).otherwise(F.lit("low"))
    w = Window.partitionBy("request_id", "segment").orderBy("rank")
    return (recs.withColumn("segment", seg)
            .withColumn("segment_rank", F.row_number().over(w).cast("int"))
            .where(F.col("segment_rank") <= per_segment)
            .select("request_id", "segment", "segment_rank", "rank", "movie_id", "similarity_score"))


def title_like_neighbours(t: ServingTables, pattern: str, limit: int = 40) -> DataFrame:
    """Case-sensitive title substring -> first matching item (smallest id) ->
    its stored neighbours by similarity (rank breaks ties), ``limit`` rows."""
    first = t.movies.where(F.col("title").contains(pattern)).agg(F.min("movie_id")).scalar()
    r = t.recommendations.where(F.col("movie_id") == first)
    out = (r.join(t.movies.select(F.col("movie_id").alias("recommended_movie_id"), "title"),
                  "recommended_movie_id")
           .orderBy(F.col("similarity_score").desc(), F.col("rank")).limit(limit))
    return out.select("title", F.col("recommended_movie_id").alias("movie_id"), "similarity_score")
