"""SparkSession construction and shared-folder helpers.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a
shared folder; we only read it.  A local folder is chosen only when the setting
is missing (unit tests on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins at
# runtime (broadcasts small sides it has measured, splits skewed partitions,
# coalesces tiny shuffle partitions).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "kinora", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set one only if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # One process (tests): nothing names a shared folder and none is needed.
        configured = tempfile.mkdtemp(prefix="kinora-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions in
    its modules run wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="kinora-package-"), "kinora.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("kinora", os.path.relpath(path, root)))
    sc.addPyFile(target)  # served by the driver
    _SHIPPED.add(sc.applicationId)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/kinora-{purpose}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    return path


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - connect sessions
        return 8


def spread(df, *keys: str, factor: int = 2):
    """Hash-partition a CPU-heavy *scan* over the cluster when it has fewer
    partitions than the cluster has cores (a single-row-group file is one
    task).  Large inputs already have enough splits and pass through without a
    shuffle.  Call it on scans only: on a plan with shuffles, asking for the
    partition count makes adaptive execution run those stages."""
    target = default_parallelism(df.sparkSession) * factor
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - connect sessions have no rdd
        return df
    if current >= default_parallelism(df.sparkSession):
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def materialize(df, purpose: str):
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    One job computes and writes the data (a reliable ``checkpoint()`` runs the
    plan once to count and again to save); readers then scan files that any
    executor can reach, so a lost executor never forces recomputation of what
    came before.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
