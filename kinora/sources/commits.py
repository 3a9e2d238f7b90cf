"""Appends that land together: staged files and a log of commits.

A store holds several tables under one folder.  ``commit`` first writes the rows of every
table to folders of their own (``data/<table>/<transaction>-<random>``), which no reader
looks at, and then one log entry (``log/<version>``) that names them all.  A log entry is a
folder that Spark's committer fills with one file in one rename, so a reader sees all
tables of a commit or none.  A transaction is committed once: said again, as after a
restart, it changes nothing and its version is returned.  ``snapshot`` pins a reader to a
version; later commits do not reach it.

One writer at a time is assumed, as with a stream's batches or a nightly job; a second one
fails on the taken log entry and may run again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "version long, txn string, table string, path string, columns string"


class Snapshot:
    """The tables of a store as of one version."""

    def __init__(self, spark: SparkSession, base: str, version: int, entries: list):
        self.spark, self.base, self.version = spark, base, version
        self._entries = entries

    def tables(self) -> list[str]:
        return sorted({e["table"] for e in self._entries})

    def read(self, table: str) -> DataFrame:
        own = [e for e in self._entries if e["table"] == table]
        if not own:
            raise KeyError(f"{self.base} has no table {table} in version {self.version}")
        # The schema is the log's: no file is opened to find it, and an empty append has none.
        return self.spark.read.schema(own[0]["columns"]).parquet(*[f"{self.base}/{e['path']}" for e in own])


class SnapshotStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _entries(self) -> list:
        """All log entries: one small row per table and commit."""
        try:
            return self.spark.read.schema(LOG).json(f"{self.base}/log/*").orderBy("version", "table").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max((e["version"] for e in self._entries()), default=0)

    def snapshot(self, version: int | None = None) -> Snapshot:
        entries = self._entries()
        newest = max((e["version"] for e in entries), default=0)
        if version is not None and not 0 <= version <= newest:
            raise ValueError(f"{self.base} has versions 0 to {newest}, not {version}")
        version = newest if version is None else version
        return Snapshot(self.spark, self.base, version, [e for e in entries if e["version"] <= version])

    def commit(self, txn: str, tables: dict[str, DataFrame]) -> int:
        """Append the rows of ``tables`` as one version; columns must be those the table has."""
        entries = self._entries()
        done = [e["version"] for e in entries if e["txn"] == txn]
        if done:
            return done[0]
        rows, version = [], max((e["version"] for e in entries), default=0) + 1
        for name, df in sorted(tables.items()):
            if not re.fullmatch(r"\w+", name):
                raise ValueError(f"no table name: {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
            held = next((e["columns"] for e in entries if e["table"] == name), columns)
            if held != columns:
                raise ValueError(f"{name} has the columns {held}, not {columns}")
            path = f"data/{name}/{re.sub(r'[^0-9A-Za-z_-]', '_', txn)}-{uuid.uuid4().hex[:12]}"
            df.write.parquet(f"{self.base}/{path}")
            rows.append((version, txn, name, path, columns))
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("error").json(f"{self.base}/log/{version:020d}")
        return version
