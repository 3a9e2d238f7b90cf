"""Catalogue append as a Structured Streaming job over landed feed pages.

Feed pages land as JSON documents, in any order, any number per run and over any number
of runs.  A page that arrived is ``ok``, ``raised`` (an error was met: it alone is
skipped), ``refused`` (a status other than 200) or ``empty``; the walk over the pages ends
before the first refused, empty or missing one, as the reference's single pass does.

State is a page ledger, two tables beside the output: the landed documents by range of
page numbers and batch, and per batch the page the walk has come to.  A batch looks at
documents from that page on only, takes those that the walk now passes, and notes where
it ends.  Documents behind it are never read again; a page that lands again before the
walk has passed it counts as it landed last, so a refused page may be repeated.

* titles already in the catalogue - including rows appended by earlier batches - are
  skipped, and new ids continue after the largest id of both (from 600000 at least);
* a batch writes only its own ``batch_id`` partitions, so one that is replayed after a
  failure replaces its rows; with a ``SnapshotStore`` its items and ratings land as one
  commit, which a replay leaves as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinora.operators import append
from kinora.session import materialize
from kinora.sources.commits import SnapshotStore

FEED_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("genre_ids", T.ArrayType(T.IntegerType())),
    T.StructField("vote_average", T.DoubleType()),
])

# A landed page: {"page": n, "status": 200, "error": null, "results": [{pos, title, ...}, ...]}
RESULT_TYPE = T.ArrayType(T.StructType([f for f in FEED_SCHEMA.fields if f.name != "page"]))
PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("results", RESULT_TYPE),
])
LEDGER_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("results", RESULT_TYPE),
    T.StructField("pages", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])
WALK_SCHEMA = "start_page int, next_page int, batch_id bigint"
PAGES_PER_RANGE = 1000   # pages of one folder of the ledger
ITEM_SCHEMA = "movie_id bigint, title string, genres string, seed_rating double, batch_id bigint"


def land_feed(feed: DataFrame, landing_dir: str, failures: DataFrame | None = None) -> str:
    """Write feed rows as page documents (JSON), as the feed service returns
    them.  One page holds a bounded number of results.  ``failures(page, status, error)``
    are pages that came without results."""
    result = F.struct(*[f.name for f in FEED_SCHEMA.fields if f.name != "page"])
    pages = feed.groupBy("page").agg(F.array_sort(F.collect_list(result)).alias("results"))
    pages = pages.select("page", F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"), "results")
    if failures is not None:
        pages = pages.unionByName(failures.select(F.col("page").cast("int"), F.col("status").cast("int"), F.col("error").cast("string")),
                                  allowMissingColumns=True)
    pages.write.mode("append").json(landing_dir)
    return landing_dir


def page_kind() -> Column:
    """What became of a landed page."""
    return (F.when(F.col("error").isNotNull(), "raised").when(F.coalesce("status", F.lit(200)) != 200, "refused")
            .when(F.coalesce(F.size("results"), F.lit(0)) <= 0, "empty").otherwise("ok"))


def _written(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that earlier batches wrote; empty before the first."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that ``df`` has, in place of what they held."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def take_reachable(spark: SparkSession, batch: DataFrame, batch_id: int, ledger: str, walk: str) -> DataFrame:
    """Note a batch's documents in the ledger and return the feed rows of the pages that
    the walk passes now."""
    docs = batch.where(F.col("page") >= 1).select("page", page_kind().alias("kind"), "results")
    _replace(docs.withColumn("pages", F.floor(F.col("page") / PAGES_PER_RANGE)).withColumn("batch_id", F.lit(batch_id).cast("bigint")),
             ledger, "pages", "batch_id")
    start = _written(spark, walk, WALK_SCHEMA).where(F.col("batch_id") < batch_id).agg(F.max("next_page")).first()[0] or 1
    # Folders of passed pages are not listed, passed pages of the current one not read.
    landed = _written(spark, ledger, LEDGER_SCHEMA).where(
        (F.col("pages") >= start // PAGES_PER_RANGE) & (F.col("page") >= start) & (F.col("batch_id") <= batch_id))
    last = landed.groupBy("page").agg(F.max(F.struct("batch_id", (F.col("kind") == "ok").alias("good"), "kind")).alias("last")).select("page", "last.batch_id", "last.kind")
    last = materialize(last, "pages")  # one row a page that the walk has not passed
    end = spark.range(1).select(append.first_unreachable(last.where(F.col("kind").isin("ok", "raised")), start)).first()[0]
    _replace(spark.createDataFrame([(start, end, batch_id)], WALK_SCHEMA), walk, "batch_id")
    passed = last.where((F.col("page") < end) & (F.col("kind") == "ok")).select("page", "batch_id")
    results = landed.where((F.col("page") < end) & (F.col("kind") == "ok")).join(passed, ["page", "batch_id"], "left_semi")
    return results.select("page", F.explode("results").alias("r")).select("page", "r.*")


def _process_batch(spark: SparkSession, base_titles: DataFrame, items_path: str, ratings_path: str,
                   run_ts: int | None, store: SnapshotStore | None):
    state = items_path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = take_reachable(spark, batch, batch_id, state + "_pages", state + "_walk")
        earlier = _written(spark, items_path, ITEM_SCHEMA).where(F.col("batch_id") < batch_id)
        ids = F.col("movie_id") if "movie_id" in base_titles.columns else F.lit(None)
        existing = base_titles.select(ids.cast("bigint").alias("movie_id"), "title").unionByName(earlier.select("movie_id", "title"))
        items = append.fresh_items(rows, existing).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        items = materialize(items, "feed-batch")  # ids are fixed before both writes read them
        ratings = append.seed_ratings(items, append.run_stamp(run_ts))
        _replace(items, items_path, "batch_id")
        _replace(ratings.withColumn("batch_id", F.lit(batch_id).cast("bigint")), ratings_path, "batch_id")
        if store is not None:
            store.commit(f"feed-{batch_id}", {"movies": items.select("movie_id", "title", "genres"), "ratings": ratings})
    return run


def run_feed_append(spark: SparkSession, landing_dir: str, base_titles: DataFrame, items_path: str,
                    ratings_path: str, checkpoint_location: str, run_ts: int | None = None,
                    store: SnapshotStore | None = None) -> None:
    """Process every landed page not yet seen, then stop (availableNow).

    ``base_titles(title[, movie_id])`` is the catalogue; give its ids wherever they may
    reach ``append.FIRST_NEW_ID``, as new ones continue after the largest.  Ratings carry ``run_ts``, or the time of the batch."""
    from kinora.session import checkpoint_dir
    checkpoint_dir(spark)
    stream = spark.readStream.schema(PAGE_SCHEMA).json(landing_dir)
    query = (stream.writeStream
             .foreachBatch(_process_batch(spark, base_titles, items_path, ratings_path, run_ts, store))
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
