"""Top-k helpers that never move a whole table into one task.

* ``global_top_n`` - ``orderBy().limit(n)`` becomes TakeOrderedAndProject: each
  partition keeps its own n best, only n rows per partition reach the final
  merge; the row_number window then runs over at most n rows.
* ``top_k_per_group`` - row_number partitioned by the group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_top_n(df: DataFrame, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("int"))
            .where(F.col(rank_col) <= k))
