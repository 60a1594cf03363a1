"""Pieces the operators share: written tables, running sums over a global
order, and connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.session import materialize, ship_package

#: The white space of all the word rules here: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back: the
    lineage ends there, so a lost executor re-reads files.  The shuffle files
    of the job that wrote it have served and go, so that a chain of such jobs
    needs the disk of its largest."""
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return materialize(df, tag)


def python_ready(df: DataFrame) -> SparkSession:
    """Make this package importable in the Python workers of ``df``'s session."""
    ship_package(df.sparkSession)
    return df.sparkSession


def row_key(*columns: str) -> Column:
    """128 bits that stand for the values of the columns."""
    return F.struct(F.xxhash64(*columns).alias("x"), F.xxhash64(F.lit(1), *columns).alias("y"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sums(df: DataFrame, group: list[str], order: list[str], sums: dict[str, str], tag: str) -> DataFrame:
    """``df`` plus, for each ``sums`` entry (new column -> value column), the
    sum over the rows of the same group that come strictly before the row.

    No group is sorted in one task: the rows are range-partitioned by group
    and order, each range is summed by itself, and the ranges' totals (one
    row per range and group) give each range its offset.  Rows equal in
    group and order follow one another in an undefined order, so the order
    must tell apart all rows that differ."""
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    cut = written(df.repartitionByRange(n, *group, *order).withColumn("__range", F.spark_partition_id()), tag)
    inner = Window.partitionBy("__range", *group).orderBy(*order)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    offsets = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("__range", *group).agg(*[F.sum(v).alias(f"__t_{k}") for k, v in sums.items()])
    totals = totals.select("__range", *[F.col(g).alias(f"__g_{g}") for g in group],
                           *[F.coalesce(F.sum(f"__t_{k}").over(offsets), F.lit(0)).alias(f"__o_{k}") for k in sums])
    local = cut.select("*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(k) for k, v in sums.items()])
    same = (F.col("__range") == F.col("__r"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    joined = local.join(totals.withColumnRenamed("__range", "__r"), same, "left")
    return joined.select(*df.columns, *[(F.col(k) + F.col(f"__o_{k}")).alias(k) for k in sums])


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Connected components of an undirected graph: ``edges`` has long
    columns ``a`` and ``b``; returns ``node, root`` (root: the smallest node
    of the component) for every node that has an edge to another.

    Alternating large-star and small-star rounds: each round hangs a node's
    neighbours on the smallest of them, which needs only a partial ``min``
    per node and a join back, never a node's neighbour list.  Each round is
    written to the shared folder; the loop ends when a round changes no
    edge."""
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), tag)

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    last = mark(cur)
    while last[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cur.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        # a node's smaller neighbours hang on the smallest of all its neighbours
        small_side = cur.join(low, "u").where(F.col("v") > F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        keep = low.where(F.col("m") < F.col("u")).select("u", F.col("m").alias("v"))
        nxt = large.unionByName(small_side).unionByName(keep).where("u > v").distinct()
        cur = written(nxt, tag)
        now = mark(cur)
        if now == last:
            break
        last = now
    rooted = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return rooted.unionByName(roots.join(rooted.select("node"), "node", "left_anti"))
