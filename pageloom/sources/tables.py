"""Table sources: parquet catalogue/page tables, line lists, raw bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.text import ws_strip

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan one table.  Projection and filters applied by the caller reach
    the parquet scan (column pruning, PushedFilters)."""
    table = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    # a small file is one split however much work its rows are: who knows the
    # cluster may have tables dealt out, always or never, not by their size
    parts = spark.conf.get("pageloom.scan.partitions", None)
    return table.repartition(int(parts)) if parts else table


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out to all cores, whatever their size in bytes: for rows
    that grow to pages, whose extraction costs far more than reading them (a
    file of a million short rows is one split, and joins put as many rows in
    one task)."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        tasks = max(tasks, 2 * spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 -- no classic context (Spark Connect)
        pass
    return rows.repartition(tasks)


def scan(spark: SparkSession, base_dir: str, name: str, columns=None,
         where: Column | None = None) -> DataFrame:
    """SRC-1: scan a catalogue table with projection and predicate."""
    df = read_table(spark, base_dir, name)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: a line-list file, each line stripped (no comment or blank
    handling, as in the original readers)."""
    return spark.read.text(path).select(ws_strip(F.col("value")).alias("line"))


def read_raw_bodies(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC-3 raw variant: one row per stored response body (``binaryFile``)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .load(path)
            .select(F.col("path").alias("url"), F.col("content").alias("body")))


def literal_seeds(spark: SparkSession, urls) -> DataFrame:
    """SRC-2: a literal seed list as a DataFrame (``url`` column)."""
    schema = T.StructType([T.StructField("seed_pos", T.IntegerType()),
                           T.StructField("url", T.StringType())])
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], schema)
