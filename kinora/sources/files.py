"""Readers for landed item / rating files, always with an explicit schema.

No ``inferSchema``: a schema pass over 100 TB is a full extra scan, and types
must not depend on the data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOVIES_CSV_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATINGS_CSV_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

LEGACY_RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

GENRE_DICT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("id", T.IntegerType()),
])


class MissingSourceError(FileNotFoundError):
    """A required source file/folder is absent."""


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, what: str, **options) -> DataFrame:
    reader = spark.read.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    try:
        df = reader.csv(path)
        df.schema  # resolves the path now, so a missing file fails here
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingSourceError(f"Missing required {what} file: {path}") from exc
        raise


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    """movies.csv with header (movieId,title,genres) -> movie_id, title, genres."""
    df = _read_csv(spark, path, MOVIES_CSV_SCHEMA, "movie metadata",
                   header=True, escape='"', multiLine=False, mode="PERMISSIVE")
    return df.withColumnRenamed("movieId", "movie_id")


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """ratings.csv with header -> user_id, movie_id, rating, timestamp."""
    df = _read_csv(spark, path, RATINGS_CSV_SCHEMA, "ratings", header=True, mode="PERMISSIVE")
    return df.withColumnRenamed("userId", "user_id").withColumnRenamed("movieId", "movie_id")


def read_legacy_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated ratings: user, item, rating, epoch seconds."""
    return _read_csv(spark, path, LEGACY_RATINGS_SCHEMA, "ratings", sep="\t", header=False)


def read_genre_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated 'name|id' genre dictionary."""
    return _read_csv(spark, path, GENRE_DICT_SCHEMA, "genre dictionary",
                     sep="|", header=False, encoding="ISO-8859-1")


def legacy_items_schema(genre_names: list[str]) -> T.StructType:
    fields = [
        T.StructField("movie_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("video_release_date", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
    fields += [T.StructField(f"g_{i}", T.IntegerType()) for i in range(len(genre_names))]
    return T.StructType(fields)


def read_legacy_items(spark: SparkSession, path: str, genre_names: list[str]) -> DataFrame:
    """Pipe-separated Latin-1 items with one 0/1 flag column per genre."""
    return _read_csv(spark, path, legacy_items_schema(genre_names), "item",
                     sep="|", header=False, encoding="ISO-8859-1")


def genre_names_from_dictionary(genres: DataFrame) -> list[str]:
    """Genre names ordered by id.  The dictionary is a handful of rows that
    define the item file's column layout, so it is read on the driver."""
    rows = genres.where(F.col("name").isNotNull()).orderBy("id").select("name").collect()
    return [r["name"] for r in rows]


def read_json_cache(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a JSON record cache.  A file holding any unreadable record counts
    as empty (the whole file is dropped, not just the bad line), as a corrupt
    cache document is discarded."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(full).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    return raw.join(_broken(raw, schema), "_file", "left_anti").drop("_file", "_corrupt_record")


def _broken(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """(_file, broken_lines) of the files that hold an unreadable record."""
    # the filter reads a data column too: Spark refuses scans that need only
    # the corrupt-record column
    first = schema.fields[0].name
    bad = F.col("_corrupt_record").isNotNull() & (
        F.length(F.concat_ws("|", F.col("_corrupt_record"), F.col(first).cast("string"))) > 0)
    return raw.where(bad).groupBy("_file").agg(F.count(F.lit(1)).alias("broken_lines"))


def quarantined_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, broken_lines): the files of a cache that ``read_json_cache`` leaves out."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(full).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    return _broken(raw, schema).withColumnRenamed("_file", "file")
