"""First-wins selections (WIN-1, WIN-2).

``first_by`` is written as ``min(struct(order..., payload...))`` grouped by
the key instead of ``row_number()`` over a window: the aggregate is
partial, so every map task collapses its own copies of a hot key before the
shuffle and no single task ever receives all rows of a key.  The result is
the same row ``row_number() = 1`` would pick for a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             payload: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple.
    ``order`` must be unique within a key for a deterministic result."""
    keys, order, payload = list(keys), list(order), [c for c in payload if c not in keys]
    picked = F.min(F.struct(*[F.col(c) for c in order + [p for p in payload if p not in order]])).alias("_w")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + [p for p in payload if p not in order]])


def first_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Same selection through ``row_number``; kept for small inputs and as
    the cross-check of :func:`first_by` in the tests."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
