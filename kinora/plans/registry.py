"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the fixture projections) and
runs over whole tables.  Keys follow SURVEY section 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.operators import metrics, ratings
from kinora.plans.build import CatalogueBuild

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _build(spark: SparkSession, sf_dir: str) -> CatalogueBuild:
    return CatalogueBuild.from_tables(spark, sf_dir, store=True)


# -- minimum slice -------------------------------------------------------------
@register("ratings_summary")
def q_ratings_summary(spark, sf_dir):
    return _build(spark, sf_dir).ratings_summary


@register("popular_movies")
def q_popular_movies(spark, sf_dir):
    return _build(spark, sf_dir).popular_movies()


# -- cleaning ------------------------------------------------------------------
@register("clean_catalog")
def q_clean_catalog(spark, sf_dir):
    return _build(spark, sf_dir).clean_movies


@register("clean_ratings")
def q_clean_ratings(spark, sf_dir):
    return _build(spark, sf_dir).clean_ratings


@register("transform_catalog")
def q_transform_catalog(spark, sf_dir):
    return _build(spark, sf_dir).transformed


@register("feature_text")
def q_feature_text(spark, sf_dir):
    return _build(spark, sf_dir).feature_items


@register("validate_raw")
def q_validate_raw(spark, sf_dir):
    b = _build(spark, sf_dir)
    return metrics.validate_raw(spark, b.raw_movies, b.item_stats)


@register("cleaning_metrics")
def q_cleaning_metrics(spark, sf_dir):
    b = _build(spark, sf_dir)
    return metrics.cleaning_metrics(spark, b.raw_movies, b.clean_movies, b.item_stats, b.known_stats)


@register("rating_histogram")
def q_rating_histogram(spark, sf_dir):
    b = _build(spark, sf_dir)
    return ratings.rating_histogram(b.pairs, b.clean_movies)


# -- features and similarity ---------------------------------------------------
def _documents(spark, sf_dir):
    from kinora.sources.fixtures import table
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _feature_items(spark, sf_dir):
    return _build(spark, sf_dir).feature_items


@register("tokens")
def q_tokens(spark, sf_dir):
    from kinora.operators import tfidf
    from kinora.session import spread
    return tfidf.tokens(spread(_documents(spark, sf_dir), "doc_id"))


@register("ngrams")
def q_ngrams(spark, sf_dir):
    from kinora.operators import tfidf
    return tfidf.term_counts(_documents(spark, sf_dir))


@register("tfidf_weights")
def q_tfidf_weights(spark, sf_dir):
    from kinora.functions.rounding import round_even
    from kinora.operators import tfidf
    w = tfidf.tfidf_weights(_documents(spark, sf_dir))
    return w.select("doc_id", "term", round_even(F.col("weight"), 9).alias("weight"))


@register("content_topk")
def q_content_topk(spark, sf_dir):
    from kinora.operators import similarity
    from kinora.plans.build import DEFAULT_TOP_K
    return similarity.content_neighbours(spark, _feature_items(spark, sf_dir), DEFAULT_TOP_K)


@register("content_topk100")
def q_content_topk100(spark, sf_dir):
    from kinora.operators import similarity
    from kinora.plans.build import PIPELINE_TOP_K
    return similarity.content_neighbours(spark, _feature_items(spark, sf_dir), PIPELINE_TOP_K)


@register("doc_similarity_topk")
def q_doc_similarity_topk(spark, sf_dir):
    from kinora.operators import similarity
    nn = similarity.content_neighbours(spark, _documents(spark, sf_dir), 10,
                                       id_col="doc_id", text_col="text")
    return nn.select("doc_id", F.col("recommended_doc_id").alias("neighbour_id"), "rank",
                     "similarity_score")


# -- serving reads -------------------------------------------------------------
def _serving(spark, sf_dir, k: int = 15):
    return _build(spark, sf_dir).serving(k)


def _list_query(**kw):
    def q(spark, sf_dir):
        from kinora.operators import serving
        return serving.list_movies(_serving(spark, sf_dir), **kw)
    return q


# FIXED VALUES of the registered listing requests.
LIST_GENRE = "promo"
SEARCH_QUERY = "Blue Anvil"

for _mode in ("popularity", "rating", "votes", "title", "year"):
    register(f"list_{_mode}")(_list_query(sort_by=_mode))
register("list_page2")(_list_query(page=2, page_size=20))
register("list_by_genre")(_list_query(genre=LIST_GENRE, page_size=50))
register("list_unknown_sort")(_list_query(sort_by="no-such-mode", page=3))


@register("list_total")
def q_list_total(spark, sf_dir):
    from kinora.operators import serving
    return serving.list_total(_serving(spark, sf_dir), LIST_GENRE)


@register("search_titles")
def q_search_titles(spark, sf_dir):
    from kinora.operators import serving
    return serving.search_titles(_serving(spark, sf_dir), SEARCH_QUERY, limit=50)


@register("lookup_by_id")
def q_lookup_by_id(spark, sf_dir):
    from kinora.operators import serving
    from kinora.sources import fixtures
    reqs = fixtures.requests(spark, sf_dir).where(F.col("request_id").isNotNull())
    return serving.lookup_by_id(_serving(spark, sf_dir), reqs)


def _simple(name, fn_name):
    def q(spark, sf_dir):
        from kinora.operators import serving
        return getattr(serving, fn_name)(_serving(spark, sf_dir))
    register(name)(q)


for _name in ("popular_list", "genre_stats", "genre_list", "genre_top6", "dataset_summary",
              "top_rated", "most_rated"):
    _simple(_name, _name)


@register("table_counts")
def q_table_counts(spark, sf_dir):
    from kinora.operators import serving
    from kinora.plans.build import POPULAR_TOP_N
    return serving.table_counts(_serving(spark, sf_dir), {"popular_movies": POPULAR_TOP_N})


# -- recommendations -----------------------------------------------------------
# FIXED VALUES of the registered recommendation requests.
TITLE_PATTERN = "blue anvil"     # case-sensitive title pattern of the ad-hoc check
SEGMENT_THRESHOLD = 1000         # fixture ids are part keys, so the split is at 1000


def _id_requests(spark, sf_dir):
    from kinora.sources import fixtures
    r = fixtures.requests(spark, sf_dir).where(F.col("request_id").isNotNull())
    return r.select("request_id", F.col("request_id").alias("movie_id"))


def _keyed_requests(spark, sf_dir):
    from kinora.sources import fixtures
    r = fixtures.requests(spark, sf_dir)
    key = F.when(F.col("request_id").isNotNull(), F.concat(F.lit("id:"), F.col("request_id").cast("string"))
                 ).otherwise(F.concat(F.lit("title:"), F.col("title")))
    return r.select(key.alias("request_key"), "request_id", "title")


def _requests_with_k(spark, sf_dir):
    top_k = F.when(F.col("request_id").isNotNull(), (F.col("request_id") % 120).cast("int")).otherwise(F.lit(10))
    return _keyed_requests(spark, sf_dir).withColumn("top_k", top_k)


def _title_queries(spark, sf_dir):
    r = _keyed_requests(spark, sf_dir).where(F.col("request_id").isNull())
    return r.select(F.col("request_key").alias("query_id"), F.col("title").alias("query"))


@register("recommend_with_fallback")
def q_recommend_with_fallback(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.recommend(_serving(spark, sf_dir, 10), _id_requests(spark, sf_dir), 10)


@register("recommend_per_row")
def q_recommend_per_row(spark, sf_dir):
    """Every request asks for its own number of rows, 1 to 10."""
    from kinora.operators import recommend
    reqs = _id_requests(spark, sf_dir).withColumn("top_k", (F.col("request_id") % 10 + 1).cast("int"))
    return recommend.recommend(_serving(spark, sf_dir, 10), reqs, 10)


@register("recommend_summary")
def q_recommend_summary(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.summarise(recommend.recommend(_serving(spark, sf_dir, 10), _id_requests(spark, sf_dir), 10))


@register("similar_breakdown")
def q_similar_breakdown(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.similar_breakdown(_serving(spark, sf_dir, 5), _id_requests(spark, sf_dir), 5)


@register("recommend_by_title")
def q_recommend_by_title(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.recommend_by_request(_serving(spark, sf_dir, 10), _keyed_requests(spark, sf_dir), 10)


@register("recommend_requests")
def q_recommend_requests(spark, sf_dir):
    """By id or title, every request with its own number of rows, some out of range."""
    from kinora.operators import recommend
    return recommend.recommend_by_request(_serving(spark, sf_dir, 100), _requests_with_k(spark, sf_dir), 10)


@register("search_batch")
def q_search_batch(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.search_batch(_serving(spark, sf_dir), _title_queries(spark, sf_dir), 20)


@register("resolve_title")
def q_resolve_title(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.resolve_titles(_serving(spark, sf_dir), _title_queries(spark, sf_dir))


@register("serve_recommendations")
def q_serve_recommendations(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.serve_neighbours(_serving(spark, sf_dir, 5), 5)


@register("segment_topk")
def q_segment_topk(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.segment_topk(_serving(spark, sf_dir, 100), _id_requests(spark, sf_dir),
                                  SEGMENT_THRESHOLD)


@register("title_like_neighbours")
def q_title_like_neighbours(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.title_like_neighbours(_serving(spark, sf_dir, 100), TITLE_PATTERN, 40)


# -- linkage and enrichment ------------------------------------------------------
# FIXED VALUE: the earlier enrichment run covered releases up to this year.
CACHED_UNTIL_YEAR = 1985
NEW_FROM_YEAR = 1980


@register("parse_title")
def q_parse_title(spark, sf_dir):
    from kinora.functions import text
    from kinora.sources import fixtures
    v = fixtures.title_variants(spark, sf_dir)
    p = text.parse_title("title")
    return v.select("movie_id", p["year"].alias("parsed_year"),
                    F.size(p["candidates"]).alias("n_candidates"),
                    F.array_join(p["candidates"], " || ").alias("candidates"))


def _link_inputs(spark, sf_dir):
    from kinora.sources import external
    items = _build(spark, sf_dir).clean_movies.select("movie_id", "title", "release_year")
    hits = external.hits(spark, sf_dir)
    return items, _links(spark, sf_dir, items, hits), hits, external.details(spark, sf_dir)


_LINK_STORES: dict[tuple[str, str], str] = {}


def _links(spark, sf_dir, items, hits):
    """The stored links of the catalogue at ``sf_dir``, linked by the application's first
    query that needs them."""
    from kinora.operators.link_store import LinkStore
    from kinora.session import work_dir
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _LINK_STORES:
        base = work_dir(spark, "links")
        LinkStore(spark, base).refresh("catalogue", items, hits)
        _LINK_STORES[at] = base
    return LinkStore(spark, _LINK_STORES[at]).links()


@register("link_external")
def q_link_external(spark, sf_dir):
    return _link_inputs(spark, sf_dir)[1].select("movie_id", "ext_id", "score", "pass")


@register("link_refresh")
def q_link_refresh(spark, sf_dir):
    """Links after a second run: the first one knew the older items and the older hits."""
    from kinora.functions import text
    from kinora.operators.link_store import LinkStore
    from kinora.session import work_dir
    from kinora.sources import external
    items = _build(spark, sf_dir).clean_movies.select("movie_id", "title", "release_year")
    hits = external.hits(spark, sf_dir)
    store = LinkStore(spark, work_dir(spark, "links-refreshed"))
    store.refresh("first", items.where(F.col("release_year") <= CACHED_UNTIL_YEAR),
                  hits.where(text.year_from_date("release_date") <= CACHED_UNTIL_YEAR))
    store.refresh("second", items, hits)
    return store.links(items).select("movie_id", "ext_id", "score", "pass")


def _records(items, links, hits, details):
    from kinora.operators import linkage
    own = links.join(items.select("movie_id"), "movie_id", "left_semi")
    return linkage.enrich_records(items, own, hits, details)


def _flat_records(df):
    return df.withColumn("cast", F.array_join("cast", ", ")).withColumnRenamed("cast", "cast_names")


@register("enrich_record")
def q_enrich_record(spark, sf_dir):
    items, links, hits, details = _link_inputs(spark, sf_dir)
    return _flat_records(_records(items, links, hits, details))


def _old_cache(items, links, hits, details):
    old_items = items.where(F.col("release_year") <= CACHED_UNTIL_YEAR)
    return _records(old_items, links, hits, details)


@register("enrich_todo")
def q_enrich_todo(spark, sf_dir):
    from kinora.operators import linkage
    items, links, hits, details = _link_inputs(spark, sf_dir)
    return linkage.enrich_todo(items, _old_cache(items, links, hits, details)).select("movie_id", "title")


@register("cache_upsert")
def q_cache_upsert(spark, sf_dir):
    from kinora.operators import linkage
    items, links, hits, details = _link_inputs(spark, sf_dir)
    old = _old_cache(items, links, hits, details).withColumn("source", F.lit("old"))
    new = _records(items.where(F.col("release_year") >= NEW_FROM_YEAR), links, hits, details).withColumn(
        "source", F.lit("new"))
    return linkage.cache_upsert(old, new).select("movie_id", "found", "meta_id", "source")


@register("enrich_coverage")
def q_enrich_coverage(spark, sf_dir):
    from kinora.operators import linkage
    from kinora.session import materialize
    items, links, hits, details = _link_inputs(spark, sf_dir)
    # The earlier run's cache is a stored table: write it to the shared folder
    # instead of re-deriving it inside this plan.
    old = materialize(_old_cache(items, links, hits, details), "media-cache-old")
    todo = linkage.enrich_todo(items, old)
    merged = linkage.cache_upsert(old, _records(todo, links, hits, details))
    return linkage.coverage(items, merged)


@register("enrich_progress")
def q_enrich_progress(spark, sf_dir):
    """Counters of the next enrichment run, taken as its records are written."""
    from kinora.operators import counters, linkage
    from kinora.session import materialize
    items, links, hits, details = _link_inputs(spark, sf_dir)
    before = counters.Counted(_old_cache(items, links, hits, details), matched=F.count_if("found"))
    old = materialize(before.rows, "media-cache-old")
    run = counters.Counted(_records(linkage.enrich_todo(items, old), links, hits, details), matched=F.count_if("found"))
    materialize(run.rows, "media-cache-new")
    return counters.progress(spark, before.get()["rows"], run.get(), before.get()["matched"])


# -- catalogue append --------------------------------------------------------------
def _run_stamp(spark, sf_dir):
    """Run timestamp taken once from the data (latest order date, epoch s)."""
    from kinora.sources.fixtures import epoch_seconds, table
    return table(spark, sf_dir, "orders").agg(F.max(epoch_seconds("o_orderdate"))).scalar()


def _new_items(spark, sf_dir):
    from kinora.operators import append
    from kinora.sources import external
    b = _build(spark, sf_dir)
    return append.new_items(external.feed(spark, sf_dir), b.raw_movies.select("movie_id", "title"))


@register("catalog_append")
def q_catalog_append(spark, sf_dir):
    return _new_items(spark, sf_dir)


@register("catalog_append_ratings")
def q_catalog_append_ratings(spark, sf_dir):
    from kinora.operators import append
    return append.seed_ratings(_new_items(spark, sf_dir), _run_stamp(spark, sf_dir))


@register("catalog_after_append")
def q_catalog_after_append(spark, sf_dir):
    b = _build(spark, sf_dir)
    return b.raw_movies.unionByName(_new_items(spark, sf_dir).select("movie_id", "title", "genres"))


# -- data quality ------------------------------------------------------------------
@register("dq_checks")
def q_dq_checks(spark, sf_dir):
    from kinora.operators import quality, serving
    t = _serving(spark, sf_dir)
    genre_rows = serving.list_movies(t, genre=LIST_GENRE, page_size=50)
    return quality.dq_checks(t, genre_rows, LIST_GENRE)


@register("dq_neighbours")
def q_dq_neighbours(spark, sf_dir):
    from kinora.operators import quality
    return quality.dq_neighbours(_serving(spark, sf_dir).recommendations)


@register("dq_popular")
def q_dq_popular(spark, sf_dir):
    from kinora.operators import quality, serving
    return quality.dq_popular(serving.popular_list(_serving(spark, sf_dir), 10))


# -- sources and sinks -------------------------------------------------------------
@register("raw_catalog")
def q_raw_catalog(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import files, fixtures, sinks
    raw = fixtures.raw_movies(spark, sf_dir).withColumnRenamed("movie_id", "movieId")
    path = sinks.land_csv(raw, work_dir(spark, "landed-movies"))
    return files.read_movies_csv(spark, path)


@register("raw_ratings")
def q_raw_ratings(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import files, fixtures, sinks
    raw = (fixtures.raw_ratings(spark, sf_dir).withColumnRenamed("user_id", "userId")
           .withColumnRenamed("movie_id", "movieId"))
    path = sinks.land_csv(raw, work_dir(spark, "landed-ratings"))
    return files.read_ratings_csv(spark, path)


def _legacy(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import files, fixtures, sinks
    base = work_dir(spark, "landed-legacy")
    sinks.land_csv(fixtures.legacy_genre_dictionary(spark, sf_dir), f"{base}/genre", sep="|", header=False,
                   encoding="ISO-8859-1")
    genres = files.read_genre_dictionary(spark, f"{base}/genre")
    names = files.genre_names_from_dictionary(genres)
    sinks.land_csv(fixtures.legacy_items(spark, sf_dir, names), f"{base}/item", sep="|", header=False,
                   encoding="ISO-8859-1")
    return genres, names, files.read_legacy_items(spark, f"{base}/item", names)


@register("legacy_genres")
def q_legacy_genres(spark, sf_dir):
    genres, _, _ = _legacy(spark, sf_dir)
    return genres.select("id", "name")


@register("compile_genres")
def q_compile_genres(spark, sf_dir):
    from kinora.operators import catalog
    _, names, items = _legacy(spark, sf_dir)
    return items.select("movie_id", "title", catalog.compile_genres(names).alias("genres"))


@register("year_with_fallback")
def q_year_with_fallback(spark, sf_dir):
    from kinora.functions import text
    _, _, items = _legacy(spark, sf_dir)
    return items.select("movie_id", text.year_with_fallback("title", "release_date").alias("release_year"))


@register("sink_roundtrip")
def q_sink_roundtrip(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import sinks
    t = _build(spark, sf_dir).transformed
    base = work_dir(spark, "processed")
    sinks.write_table(t, f"{base}/movies_processed.parquet")
    sinks.write_table(t, f"{base}/movies_processed.csv", fmt="csv")
    return sinks.read_table(spark, f"{base}/movies_processed.parquet")


def _written_serving(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import sinks
    t = _serving(spark, sf_dir)
    base = work_dir(spark, "serving")
    paths = sinks.write_serving(t, base)
    return {k: sinks.read_table(spark, p) for k, p in paths.items()}


@register("source_readiness")
def q_source_readiness(spark, sf_dir):
    """Rows of every required raw source, counted as it is landed."""
    from kinora.operators import counters
    from kinora.session import work_dir
    from kinora.sources import fixtures, sinks

    def landed(name, df, **options):
        def use():
            counted = counters.Counted(df)
            sinks.land_csv(counted.rows, work_dir(spark, f"landed-{name}"), **options)
            return counted
        return use
    return counters.readiness(spark, {
        "movies": landed("movies", fixtures.raw_movies(spark, sf_dir)),
        "ratings": landed("ratings", fixtures.raw_ratings(spark, sf_dir)),
        "legacy_ratings": landed("data", fixtures.raw_ratings(spark, sf_dir), sep="\t", header=False),
        "legacy_genres": landed("genre", fixtures.legacy_genre_dictionary(spark, sf_dir), sep="|", header=False)})


@register("store_status")
def q_store_status(spark, sf_dir):
    """Rows of every serving table, counted as it is written, and the store's status."""
    from kinora.operators import counters
    from kinora.plans.build import POPULAR_TOP_N
    from kinora.session import work_dir
    from kinora.sources import sinks
    counts = sinks.write_serving_counted(_serving(spark, sf_dir), work_dir(spark, "serving"))
    return counters.store_status(spark, counts, {"popular_movies": POPULAR_TOP_N})


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """The summary written as CSV beside its Parquet form, and read back with its schema."""
    from kinora.session import work_dir
    from kinora.sources import sinks
    summary = _build(spark, sf_dir).ratings_summary
    path = sinks.write_table(summary, f"{work_dir(spark, 'processed')}/ratings_summary.csv", fmt="csv")
    return sinks.read_table(spark, path, fmt="csv", schema=summary.schema)


@register("serving_movies")
def q_serving_movies(spark, sf_dir):
    return _written_serving(spark, sf_dir)["movies"]


@register("serving_ratings_summary")
def q_serving_ratings_summary(spark, sf_dir):
    return _written_serving(spark, sf_dir)["ratings_summary"]


@register("serving_recommendations")
def q_serving_recommendations(spark, sf_dir):
    return _written_serving(spark, sf_dir)["recommendations"]


@register("serving_popular_movies")
def q_serving_popular_movies(spark, sf_dir):
    return _written_serving(spark, sf_dir)["popular_movies"]


# -- display, request validation, pipeline metrics -----------------------------------
@register("display_card")
def q_display_card(spark, sf_dir):
    from kinora.functions import display
    from kinora.operators import recommend
    recs = recommend.recommend(_serving(spark, sf_dir, 5), _id_requests(spark, sf_dir), 5,
                               include_not_found=False)
    return recs.select("request_id", "rank", "movie_id", *display.card(recs))


@register("request_validation")
def q_request_validation(spark, sf_dir):
    from kinora.operators import recommend
    return recommend.validate_requests(_requests_with_k(spark, sf_dir)).select("request_key", "top_k", "valid", "reason")


@register("pipeline_metrics")
def q_pipeline_metrics(spark, sf_dir):
    from kinora.plans.pipeline import metrics_table
    return metrics_table(spark, _build(spark, sf_dir))


# -- streaming form of the append ------------------------------------------------------
def _run_seconds(spark, sf_dir) -> int:
    return int(spark.range(1).select(_run_stamp(spark, sf_dir)).first()[0])


@register("catalog_append_stream")
def q_catalog_append_stream(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import external
    from kinora.streaming import feed_append
    base = work_dir(spark, "feed-stream")
    feed_append.land_feed(external.feed(spark, sf_dir), f"{base}/landing")
    feed_append.run_feed_append(spark, f"{base}/landing", _build(spark, sf_dir).raw_movies.select("movie_id", "title"),
                                f"{base}/items", f"{base}/ratings", f"{base}/_checkpoint", _run_seconds(spark, sf_dir))
    return spark.read.parquet(f"{base}/items").select("movie_id", "title", "genres", "seed_rating")


@register("feed_page_status")
def q_feed_page_status(spark, sf_dir):
    """Feed pages over two runs: every ninth page raises, the fifth last is refused at first
    and repeated by the second run.  Per page what became of it and whether the walk passed it."""
    from kinora.session import work_dir
    from kinora.sources import external
    from kinora.streaming import feed_append
    base = work_dir(spark, "feed-status")
    feed = external.feed(spark, sf_dir)
    top = int(feed.agg(F.max("page")).first()[0])
    raised, refused = F.col("page") % 9 == 0, F.col("page") == top - 4
    pages = feed.select("page").distinct()
    failures = pages.where(raised | refused).select("page", F.when(refused, 503).alias("status"), F.when(raised & ~refused, "timed out").alias("error"))
    catalogue = _build(spark, sf_dir).raw_movies.select("movie_id", "title")
    for rows, failed in ((feed.where(~raised & ~refused), failures), (feed.where(refused), None)):
        feed_append.land_feed(rows, f"{base}/landing", failed)
        feed_append.run_feed_append(spark, f"{base}/landing", catalogue, f"{base}/items", f"{base}/ratings",
                                    f"{base}/_checkpoint", _run_seconds(spark, sf_dir))
    ledger = spark.read.schema(feed_append.LEDGER_SCHEMA).parquet(f"{base}/items_pages")
    end = spark.read.schema(feed_append.WALK_SCHEMA).parquet(f"{base}/items_walk").agg(F.max("next_page")).scalar()
    return ledger.groupBy("page").agg(F.max_by("kind", "batch_id").alias("kind"), F.count(F.lit(1)).alias("landings")).withColumn(
        "passed", F.col("page") < end)


@register("summary_after_append")
def q_summary_after_append(spark, sf_dir):
    """The rating summary over catalogue and ratings after the feed was appended to both
    stored sources by one commit."""
    from kinora.operators import append
    from kinora.session import materialize, work_dir
    from kinora.sources.commits import SnapshotStore
    b = _build(spark, sf_dir)
    store = SnapshotStore(spark, work_dir(spark, "sources"))
    store.commit("sources", {"movies": b.raw_movies, "ratings": b.raw_ratings})
    items = materialize(_new_items(spark, sf_dir), "appended-items")
    store.commit("feed", {"movies": items.select("movie_id", "title", "genres"),
                          "ratings": append.seed_ratings(items, _run_stamp(spark, sf_dir))})
    now = store.snapshot()
    return CatalogueBuild(now.read("movies"), now.read("ratings"), store=True).ratings_summary


# -- versioned cache write (merge, then switch) ---------------------------------------------
@register("cache_versioned")
def q_cache_versioned(spark, sf_dir):
    from kinora.operators import linkage
    from kinora.session import work_dir
    from kinora.sources import sinks
    items, links, hits, details = _link_inputs(spark, sf_dir)
    base = work_dir(spark, "media-cache")
    old = _old_cache(items, links, hits, details).withColumn("source", F.lit("old"))
    sinks.write_version(old.select("movie_id", "found", "meta_id", "source"), base, 1)
    current = sinks.read_latest(spark, base)
    new = _records(items.where(F.col("release_year") >= NEW_FROM_YEAR), links, hits, details).withColumn(
        "source", F.lit("new")).select("movie_id", "found", "meta_id", "source")
    # the merged version is written next to the one being read, never over it
    sinks.write_version(linkage.cache_upsert(current, new), base, 2)
    return sinks.read_latest(spark, base)


# -- more sources: headerless TSV, SQL on a Parquet path, JSON cache ------------------------
@register("legacy_ratings_tsv")
def q_legacy_ratings_tsv(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import files, fixtures, sinks
    path = sinks.land_csv(fixtures.raw_ratings(spark, sf_dir), work_dir(spark, "landed-tsv"), sep="\t",
                          header=False)
    return files.read_legacy_ratings(spark, path)


@register("sql_on_parquet_path")
def q_sql_on_parquet_path(spark, sf_dir):
    from kinora.operators.serving import TOP_RATED_MIN_VOTES
    from kinora.session import work_dir
    from kinora.sources import sinks
    path = sinks.write_table(_build(spark, sf_dir).ratings_summary, work_dir(spark, "summary-parquet"))
    return spark.sql(f"SELECT movie_id, avg_rating, rating_count FROM parquet.`{path}` "
                     f"WHERE rating_count >= {int(TOP_RATED_MIN_VOTES)}")


@register("media_cache_json")
def q_media_cache_json(spark, sf_dir):
    from kinora.session import work_dir
    from kinora.sources import files
    items, links, hits, details = _link_inputs(spark, sf_dir)
    base = work_dir(spark, "media-cache-json")
    cols = ["movie_id", "found", "meta_id"]
    old = _old_cache(items, links, hits, details).select(*cols)
    old.write.mode("overwrite").json(f"{base}/old")
    # The next run's records, as many files as it has tasks, and a file that broke while written.
    _records(items.where(F.col("release_year") > CACHED_UNTIL_YEAR), links, hits, details).select(*cols).write.mode("overwrite").json(f"{base}/new")
    spark.range(1).select(F.lit('{"movie_id": 1, "found": tru').alias("value")).write.mode("overwrite").text(f"{base}/broken")
    schema = old.schema
    return files.read_json_cache(spark, f"{base}/*", schema)


# -- leaderboard slice and media view --------------------------------------------------------
@register("leaderboard_top5")
def q_leaderboard_top5(spark, sf_dir):
    from kinora.operators import serving
    return serving.most_rated(_serving(spark, sf_dir)).where(F.col("rank") <= 5)


@register("media_view")
def q_media_view(spark, sf_dir):
    from kinora.functions import display
    from kinora.operators import serving
    items, links, hits, details = _link_inputs(spark, sf_dir)
    rec = _records(items, links, hits, details)
    view = serving.catalog_view(_serving(spark, sf_dir)).select("movie_id", "title", "rating_count")
    return rec.join(view, "movie_id").select(
        "movie_id", "found", "title",
        F.coalesce("overview", F.lit("")).alias("overview"),
        F.coalesce("director", F.lit("")).alias("director"),
        F.array_join(F.coalesce("cast", F.array().cast("array<string>")), ", ").alias("cast_text"),
        F.coalesce("tagline", F.lit("")).alias("tagline"), "meta_id",
        display.image_path("w500", "poster_path").alias("poster_url"),
        display.image_path("w1280", "backdrop_path").alias("backdrop_url"),
        display.runtime_text("runtime").alias("runtime_text"),
        F.when(F.coalesce("meta_rating", F.lit(0.0)) != 0, display.rating_text("meta_rating"))
         .alias("meta_rating_text"),
        F.format_number(F.col("rating_count"), 0).alias("votes_text"),
        "trailer_key")
