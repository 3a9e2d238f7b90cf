"""Rounding helpers.

Spark's ``round`` is HALF_UP on the decimal expansion, which differs from the
pipeline's float rounding (half-even on the binary value) and from SQL engines
in a few hundred cases per ten thousand.  Two explicit forms are used instead:

* ``round_even(x, d)`` = ``rint(x * 10^d) / 10^d`` - the pipeline (pandas) form
* ``round_half_up(x, d)`` = ``floor(x * 10^d + 0.5) / 10^d`` - the SQL form,
  used only on non-negative values.

The oracle SQL writes the same arithmetic, so both engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(col: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def round_half_up(col: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def sql_round_even(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)!r}"
    return f"(round_even(CAST(({expr}) AS DOUBLE) * {scale}, 0) / {scale})"


def sql_round_half_up(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)!r}"
    return f"(floor(CAST(({expr}) AS DOUBLE) * {scale} + 0.5) / {scale})"
