"""Incremental page intake (STR-1) with Structured Streaming.

New page files arrive in a folder; each micro-batch extracts the links
(EXT-2) and hands them to ``foreachBatch``, which picks the first occurrence
of each URL in the batch and stores it with insert-ignore semantics (SNK-2)
into a table folder: a replayed batch finds its URLs already stored and adds
nothing.  The table is partitioned by a hash of the URL and a batch reads
only the partitions it touches.  Both the checkpoint and the table live
under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.extract import page_links
from pageloom.operators.windows import first_by
from pageloom.session import checkpoint_dir

PAGES_SCHEMA = "page_id bigint, url string, html string"


def link_stream(spark: SparkSession, source: str, glob: str = "*.parquet", schema: str = PAGES_SCHEMA,
                event_time: str | None = None, delay: str = "1 day", files_per_batch: int | None = None) -> DataFrame:
    """Links of the page files that arrive in the folder ``source``.  ``glob``
    names files or table folders of part files in it; a micro-batch takes
    all files that are there, or ``files_per_batch`` of them.

    With an arrival-time column, copies of a URL within ``delay`` of its
    first arrival are dropped already here, in state that the watermark
    bounds (``dropDuplicatesWithinWatermark``)."""
    # as a pattern (the braces), the path may be a file or a folder
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.parquet(f"{source.rstrip('/')}/{{{glob}}}")
    if event_time is None:
        return page_links(pages)
    links = page_links(pages.withColumnRenamed(event_time, "_t"), extra=("_t",))
    return links.withWatermark("_t", delay).dropDuplicatesWithinWatermark(["url"]).drop("_t")


LINKS_SCHEMA = "url string, anchor_text string, parent_id bigint, epoch bigint, bucket int"
#: Partitions of the stored table.
BUCKETS = 16


def _store_batch(table_dir: str):
    def store(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        first = first_by(batch, ["url"], ["page_id", "pos"], ["anchor_text"])
        fresh = first.select("url", "anchor_text", F.col("page_id").alias("parent_id"),
                             F.lit(epoch_id).cast("bigint").alias("epoch"),
                             F.pmod(F.xxhash64("url"), F.lit(BUCKETS)).cast("int").alias("bucket")).persist()
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # BUCKETS at most
        stored = (spark.read.schema(LINKS_SCHEMA).parquet(table_dir).where(F.col("bucket").isin(touched))
                  .select("bucket", "url"))
        (fresh.join(stored, ["bucket", "url"], "left_anti").repartition("bucket")
         .write.mode("append").partitionBy("bucket").parquet(table_dir))
        fresh.unpersist()
    return store


def run_link_intake(spark: SparkSession, source: str, glob: str = "*.parquet", name: str | None = None,
                    files_per_batch: int | None = None) -> str:
    """Process every file present in ``source`` (``availableNow``) and return
    the folder of the link table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream_links/{name or uuid.uuid4().hex}"
    table_dir, ckpt = f"{base}/table", f"{base}/checkpoint"
    spark.createDataFrame([], LINKS_SCHEMA).write.mode("ignore").partitionBy("bucket").parquet(table_dir)
    q = (link_stream(spark, source, glob, files_per_batch=files_per_batch).writeStream.foreachBatch(_store_batch(table_dir))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return table_dir
