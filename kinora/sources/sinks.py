"""Writers for processed artefacts and serving tables.

* ``write_table``: overwrite a table; serving tables are range-partitioned and
  sorted on their key so Parquet min/max statistics skip row groups on key
  lookups (the stand-in for the reference's B-tree indexes).
* ``write_version`` / ``read_latest``: merge-then-switch without ever
  overwriting the data being read - each write appends a new ``version``
  partition; readers take the newest one (partition pruning).
* ``land_csv``: write a frame as header CSV (the raw-file format of the sources).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: key layout of the serving tables.
SERVING_KEYS = {
    "movies": ["movie_id"],
    "ratings_summary": ["movie_id"],
    "recommendations": ["movie_id", "rank"],
    "popular_movies": ["rank"],
}


def laid_out(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Ranges of the keys, sorted.  Unless a number of files is asked for, adaptive
    execution merges ranges up to its advisory size: files follow from the bytes."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", keys: list[str] | None = None,
                partitions: int | None = None) -> str:
    out = laid_out(df, keys, partitions) if keys else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def land_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
             encoding: str = "UTF-8") -> str:
    (df.write.mode("overwrite").option("header", header).option("sep", sep)
     .option("escape", '"').option("encoding", encoding).csv(path))
    return path


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write ``df`` as version ``version`` of the table at ``base``; written again, a
    version is replaced, so a retried run does not double its rows."""
    (df.withColumn("version", F.lit(int(version)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(base))
    return base


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    all_versions = spark.read.parquet(base)
    newest = all_versions.agg(F.max("version")).scalar()
    return all_versions.where(F.col("version") == newest).drop("version")


def write_serving_counted(tables, base: str) -> dict[str, int]:
    """``write_serving``, with each table's rows counted in the pass that writes it."""
    from kinora.operators.counters import Counted
    counts = {}
    for name, keys in SERVING_KEYS.items():
        # Counted behind the range exchange, whose sampling reads the rows before it twice.
        counted = Counted(laid_out(getattr(tables, name), keys))
        write_table(counted.rows, f"{base.rstrip('/')}/{name}")
        counts[name] = counted.get()["rows"]
    return counts


def write_serving(tables, base: str) -> dict[str, str]:
    """Rebuild the four serving tables from scratch under ``base``."""
    paths = {}
    for name, keys in SERVING_KEYS.items():
        df = getattr(tables, name)
        paths[name] = write_table(df, f"{base.rstrip('/')}/{name}", keys=keys)
    return paths
