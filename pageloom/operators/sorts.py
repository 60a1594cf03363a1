"""Ordered limits (SRT-2) that stay distributed for large k.

``orderBy(...).limit(k)`` keeps the first k rows of every partition and one
task merges k x (number of partitions) of them.  ``top_k`` finds the leading
key of the k-th row first: the key becomes a 64-bit number of the same order,
rows are counted by its first 16 bits, then, within the value that holds the
k-th row, by the next 16, and so on.  A count has at most 65,537 groups
(a partial aggregate), however the keys are spread: an outlier costs nothing.
Only rows up to that key are ordered.  All of it is one lazy plan, the same at
every size; the result equals ``orderBy(order).limit(k)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 16
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def rank_key(c: Column, kind: T.DataType) -> Column:
    """``c`` as a long that never falls as ``c`` grows (NULL lowest, NaN
    highest).  Fractions go by the logarithm, so that neither huge nor tiny
    ones fall together; what does fall together is only ordered later."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        key = c.cast("long")
    elif isinstance(kind, T.DateType):
        key = F.unix_date(c).cast("long")
    elif isinstance(kind, T.TimestampType):
        key = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):  # to the second: no time zone comes into it
        key = F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))
    else:
        v = c.cast("double")
        size = F.least(F.log1p(F.abs(v)), F.lit(1000.0)) * float(1 << 52)
        key = F.when(F.isnan(v), F.lit(_HIGHEST)).otherwise(F.when(v < 0, -size).otherwise(size).cast("long"))
    return F.when(c.isNull(), F.lit(_LOWEST)).otherwise(key)


def _kth(keys: DataFrame, k: int) -> DataFrame:
    """One row ``cut``: the k-th smallest ``key``, NULL where there are fewer."""
    cut = None
    for shift in range(64 - BITS, -1, -BITS):
        prefix, seen = F.shiftright("key", shift), keys
        if cut is not None:  # rows below the value that holds the k-th row count as one group
            held, before = cut.scalar(), F.shiftright("key", shift + BITS)
            seen = keys.where(before <= held)
            prefix = F.when(before < held, F.lit(_LOWEST)).otherwise(prefix)
        counts = seen.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        so_far = F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        cut = counts.withColumn("so_far", so_far).where(F.col("so_far") >= k).agg(F.min("prefix").alias("cut"))
    return cut


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Exact first ``k`` rows by ``order`` (ascending, nulls first;
    ``order[0]`` numeric, date or timestamp).  The leading column is read
    once per 16 bits besides; a costly ``df`` is better written first."""
    order = list(order)
    key = rank_key(F.col(order[0]), df.schema[order[0]].dataType)
    cut = _kth(df.select(key.alias("key")), k).select(F.coalesce("cut", F.lit(_HIGHEST)))
    return df.where(key <= cut.scalar()).orderBy(*order).limit(k)
