"""The full batch pipeline: ingest -> validate -> clean -> transform ->
recommend -> serve -> report.

``run_pipeline`` composes the lazily defined products of ``CatalogueBuild``
and writes the processed artefacts and the four serving tables.  Intermediate
products that several outputs read (the item-level rating table, the cleaned
catalogue, the neighbour table) are cut out of the lineage as
tables written to the shared checkpoint folder, so a lost executor recomputes
from the last written table, not from the raw ratings.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.operators import metrics as M
from kinora.plans.build import PIPELINE_TOP_K, POPULAR_TOP_N, CatalogueBuild
from kinora.session import checkpoint_dir, materialize, work_dir
from kinora.sources import sinks


def _metric_rows(spark: SparkSession, one_row: DataFrame) -> DataFrame:
    """(metric, value double) rows from a one-row frame of numbers."""
    cols = one_row.columns
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return one_row.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")


def metrics_table(spark: SparkSession, b: CatalogueBuild, k: int = PIPELINE_TOP_K,
                  recommendations: DataFrame | None = None) -> DataFrame:
    """End-of-run report as (metric, value) rows."""
    from kinora.functions.rounding import round_even
    recs = recommendations if recommendations is not None else b.recommendations(k)
    ingest = M.validate_raw(spark, b.raw_movies, b.item_stats)
    clean = M.cleaning_metrics(spark, b.raw_movies, b.clean_movies, b.item_stats, b.known_stats)
    s = b.ratings_summary
    transform = s.agg(
        F.count(F.lit(1)).alias("movies_with_ratings"),
        round_even(F.avg("rating_count"), 2).alias("mean_rating_count"),
        F.max("rating_count").alias("max_rating_count"),
    ).select(b.clean_movies.agg(F.count(F.lit(1))).scalar().alias("transformed_movies_count"), "*",
             round_even(b.global_mean, 2).alias("global_rating_mean"))
    units = F.rint(F.col("similarity_score") * 1e4)
    rec = recs.agg(
        F.count(F.lit(1)).alias("total_recommendations"),
        F.count_distinct("movie_id").alias("movies_with_recommendations"),
        (F.rint(F.sum(units) / F.count(units)) / 1e4).alias("avg_similarity_score"),
    ).select("*", b.popular_movies(POPULAR_TOP_N).agg(F.count(F.lit(1))).scalar()
             .alias("total_popular_movies"))
    out = None
    for part in (ingest, clean, transform, rec):
        rows = _metric_rows(spark, part)
        out = rows if out is None else out.unionByName(rows)
    return out


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                 k: int = PIPELINE_TOP_K) -> dict:
    """Run every stage, write artefacts, return timings and the report rows."""
    t0 = time.time()
    checkpoint_dir(spark)
    out_dir = out_dir or work_dir(spark, "pipeline")
    b = CatalogueBuild.from_tables(spark, sf_dir, store=True)
    timings = {}

    t = time.time()
    # item-level rating table and cleaned catalogue feed every later stage
    b.item_stats, b.clean_movies  # written to the shared folder here
    timings["clean"] = time.time() - t

    t = time.time()
    sinks.write_table(b.transformed, f"{out_dir}/processed/movies_processed.parquet")
    sinks.write_table(b.ratings_summary, f"{out_dir}/processed/ratings_summary.parquet")
    timings["transform"] = time.time() - t

    t = time.time()
    recs = materialize(b.recommendations(k), "recommendations")
    timings["recommend"] = time.time() - t

    t = time.time()
    serving = b.serving(k, recommendations=recs)
    paths = sinks.write_serving(serving, f"{out_dir}/serving")
    timings["serve"] = time.time() - t

    report = metrics_table(spark, b, k, recommendations=recs).collect()
    timings["total"] = time.time() - t0
    return {"timings": timings, "paths": paths, "report": {r["metric"]: r["value"] for r in report}}
