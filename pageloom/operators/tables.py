"""Table maintenance (SNK-1 to SNK-4) as functions ``(old, new) ->
DataFrame`` plus writers.

NULL means "absent, leave the stored value", ``''`` means "set to empty";
``coalesce(new, old)`` keeps the two apart.  Results are written as a new
table version (a fresh folder) and then switched to, so no job overwrites a
table it is still reading.  ``MERGE INTO`` needs a v2 table format; plain
parquet gets the same result through joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.windows import first_by


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """SNK-1: append rows (by column name)."""
    return old.unionByName(new)


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SNK-2: rows of ``new`` whose key is not stored yet are added (columns
    ``new`` lacks are NULL); within the batch the first row by ``order``
    wins; stored rows are kept as they are.  The in-batch pick is a partial aggregate and the stored keys are
    de-duplicated before the anti join, so hot keys collapse map-side."""
    key, order = list(key), list(order)
    payload = [c for c in new.columns if c not in key and c not in order]
    firsts = first_by(new, key, order, payload).select(*new.columns)
    fresh = firsts.join(old.select(*key).distinct(), key, "left_anti")
    # inserted rows supply some columns; the others are absent (NULL)
    cols = [F.col(c) if c in fresh.columns else F.lit(None).cast(old.schema[c].dataType).alias(c)
            for c in old.columns]
    return old.unionByName(fresh.select(*cols))


def one_change(changes: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One change row per key.  With ``order`` (columns that say which change
    came later; not part of the result) the changes are applied in sequence:
    per column the last non-NULL value.  Without it the row with the smallest
    values stays, whole.  Either is a partial aggregate."""
    cols = [c for c in changes.columns if c not in key and c not in order]
    if not cols:
        return changes.select(*key).distinct()
    if order:
        later = F.struct(*[F.col(c) for c in order])
        return changes.groupBy(*key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), later)).alias(c) for c in cols])
    picked = changes.groupBy(*key).agg(F.min(F.struct(*cols)).alias("_c"))
    return picked.select(*key, *[F.col(f"_c.{c}").alias(c) for c in cols])


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """SNK-3: insert new keys; for existing keys overwrite only the columns
    the change row supplies (non-NULL).  ``new`` may lack columns, which then
    count as absent, and may repeat keys (:func:`one_change`).  One full
    outer join on the key."""
    key = list(key)
    new = one_change(new, key, list(order))
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, key, "full_outer")
    cols = []
    for c in old.columns:
        if c in key:
            cols.append(F.col(c))
        elif c in new.columns:
            cols.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return j.select(*cols)


def keyed_update(old: DataFrame, changes: DataFrame, key: Sequence[str], unique: bool = False,
                 order: Sequence[str] = ()) -> DataFrame:
    """SNK-4: ``UPDATE t SET ... WHERE key = ...``: stored rows whose key is
    in ``changes`` take its non-NULL columns; keys not stored are ignored.
    Unless the caller knows the change keys are unique (``unique``),
    ``changes`` is reduced to one row per key first (:func:`one_change`)."""
    key = list(key)
    ch = changes.drop(*order) if unique else one_change(changes, key, list(order))
    upd = [c for c in ch.columns if c not in key]
    j = old.alias("o").join(ch.alias("n"), key, "left")
    return j.select(*[F.col(c) if c in key else
                      (F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) if c in upd else F.col(f"o.{c}").alias(c))
                      for c in old.columns])


def write_version(df: DataFrame, table_root: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version folder of a table and return its path;
    readers switch to the new folder once the write has committed."""
    path = f"{table_root.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
