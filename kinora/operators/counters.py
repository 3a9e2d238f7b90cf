"""Counters taken in the pass that writes or reads the rows anyway.

``Counted`` attaches an ``Observation`` to a frame; once an action has run over it the
numbers are there, without a scan of their own.  On them rest the readiness report of raw
sources, the status of the serving store and the progress of an enrichment run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinora.sources.files import MissingSourceError


class Counted:
    """``rows`` is the frame to use; ``get`` waits for an action on it."""

    def __init__(self, df: DataFrame, **numbers: Column):
        self._seen = Observation()
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in numbers.items()])

    def get(self) -> dict[str, int]:
        return {name: int(value or 0) for name, value in self._seen.get.items()}


def readiness(spark: SparkSession, sources: dict[str, Callable[[], Counted]]) -> DataFrame:
    """(source, row_count, ready) of required sources, each named with a function that reads
    or lands it and returns its counter; one that is missing or empty is not ready."""
    rows = []
    for name, use in sources.items():
        try:
            n = use().get()["rows"]
        except MissingSourceError:
            n = 0
        rows.append((name, n, n > 0))
    return spark.createDataFrame(rows, "source string, row_count long, ready boolean")


def store_status(spark: SparkSession, counts: dict[str, int], minimums: dict[str, int]) -> DataFrame:
    """(table_name, row_count, min_rows, ok, status): the status is the whole store's,
    ``healthy`` if every table has its rows."""
    rows = [(name, n, int(minimums.get(name, 1))) for name, n in counts.items()]
    status = "healthy" if rows and all(n >= least for _, n, least in rows) else "unhealthy"
    return spark.createDataFrame([(name, n, least, n >= least, status) for name, n, least in rows],
                                 "table_name string, row_count long, min_rows long, ok boolean, status string")


def progress(spark: SparkSession, cached: int, run: dict[str, int], found_before: int) -> DataFrame:
    """One row of an enrichment run: items cached before, to do, done and matched by this
    run, and the coverage after it in per cent (1 decimal).  ``run`` is the counter of the
    run's records with the number ``matched``."""
    catalog, found = cached + run["rows"], found_before + run["matched"]
    row = [(catalog, cached, run["rows"], run["rows"], run["matched"], float(found), float(catalog))]
    df = spark.createDataFrame(row, "catalog_count long, cached_count long, todo_count long, done_count long, matched_count long, f double, c double")
    return df.withColumn("coverage_pct", F.when(F.col("c") > 0, F.rint(F.lit(100.0) * F.col("f") / F.col("c") * 10) / 10)).drop("f", "c")
