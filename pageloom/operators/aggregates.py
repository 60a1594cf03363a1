"""Aggregations (AGG-1 to AGG-3, AGG-6).  All are partial (map-side
combined) aggregates; none gathers a group's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def count_by_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """AGG-1: one count per key, computed once instead of per lookup."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-2 / AGG-3: ``SELECT DISTINCT`` over one or several columns."""
    return df.select(*cols).dropDuplicates(list(cols))


def observed(df: DataFrame, name: str, *metrics) -> tuple[DataFrame, Observation]:
    """AGG-6: row counts (and any other metrics) of a batch, gathered while
    the job runs -- no extra pass.  Read ``observation.get`` after the
    action that consumes the returned DataFrame."""
    obs = Observation(name)
    exprs = list(metrics) or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs
