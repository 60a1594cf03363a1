"""Surrogate ids of stored rows (JOIN-4, SNK-2): what an auto-increment key
does, without one task that counts.

New rows are range-partitioned by their order and written with the number of
their range; the ranges' sizes (one row per range) give each range its first
id.  The ids depend on the rows alone, so a rerun gives the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.operators.frontier import unseen
from pageloom.operators.windows import first_by
from pageloom.session import materialize


def numbered(rows: DataFrame, order: Sequence[str], after: int = 0, id_col: str = "id") -> DataFrame:
    """``rows`` with ``id_col``: ``after + 1``, ``after + 2``, ... by ``order``,
    which must tell the rows apart."""
    order = list(order)
    cut = materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ids")
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(F.col("__range").alias("of")).agg(F.count(F.lit(1)).alias("n"))  # one row per range
    first = sizes.select("of", (F.coalesce(F.sum("n").over(before), F.lit(0)) + after).alias("__first"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    placed = cut.withColumn("__place", place).join(first, F.col("__range") == F.col("of"))
    return placed.select(*rows.columns, (F.col("__first") + F.col("__place")).cast("bigint").alias(id_col))


def store_groups(links: DataFrame, stored: DataFrame) -> DataFrame:
    """EXT-14 / JOIN-4: the rows that nested group links add to the stored
    groups (``href, anchor_text, id, pid``), whose key is ``href``.  Groups
    come first; sub-groups take the id of their parent's row, which is stored
    by then.  Each is added only if its link is not stored yet, the first
    occurrence in page order; ids go on from the largest stored one."""
    def fresh(level: int, known: DataFrame, payload: list[str]) -> DataFrame:
        rows = first_by(links.where(F.col("level") == level), ["href"], ["page_id", "pos"], payload)
        return unseen(rows, known, key="href")

    def largest(rows: DataFrame) -> int:
        return rows.agg(F.max("id")).first()[0] or 0

    columns = ["href", "anchor_text", "id", "pid"]
    groups = materialize(numbered(fresh(1, stored, ["anchor_text"]), ["page_id", "pos"], largest(stored)).withColumn(
        "pid", F.lit(None).cast("bigint")).select(columns), "groups")
    known = stored.select(columns).unionByName(groups)
    subs = fresh(2, known, ["anchor_text", "parent_href"]).join(
        known.select(F.col("href").alias("parent_href"), F.col("id").alias("pid")), "parent_href")
    return groups.unionByName(numbered(subs, ["page_id", "pos"], largest(known)).select(columns))
