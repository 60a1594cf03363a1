"""Operator 6: exact dedup by a stateful stream.

The documents are read as a stream; its keyed state (RocksDB, on disk, never
expiring) holds for every digest the row that stays so far -- its identifier
and its content locator, the file and the row in it -- and the size of the
group.  Rows with a digest that was seen are hits: the whole texts of such
groups are compared, and texts that differ under one digest are told apart.
All of it is DataFrame functions.

Texts are equal when identical after each run of white space became one
space.  Of equal texts the row with the smallest identifier stays; of rows
that also share it, the one whose locator (file, then row) comes first.

Cases: a null text is the empty text and equal to it; a null identifier
comes after all others; repeated rows are copies like any other; an empty
table gives an empty table.  Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.common import settings, written
from pageloom.session import checkpoint_dir, new_run_id

#: Keys over which the rows of one digest are dealt for the comparison of bytes.
SPREAD = 32

#: The state store: on disk, with a bound for the memory of one executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no disk set aside by stores that hold little
}


def normal(text: Column) -> Column:
    """Each run of white space as one space; runs that already are one are left alone."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digest, and where the row stands: unknown ids last, then by locator."""
    return table.select(
        F.sha2(normal(F.col(text_col)), 256).alias("digest"),
        F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"),
                 F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"),
        F.col(text_col).alias("text"))


def first_by_digest(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                    checkpoint: str | None = None, bytes_per_batch: int = 1 << 36) -> DataFrame:
    """Run the stream over all files that the parquet table at ``path`` has
    now: ``digest, at`` (the row that stays), ``n``.  With the ``checkpoint``
    of an earlier run only files added since are read, and the state goes on
    from there.  A batch writes the digests it touched under its number, so a
    batch that runs again replaces its own rows; the newest word on a digest
    is the smallest locator and the largest count."""
    home = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/exact-{new_run_id()}"
    folder, name = path.rstrip("/").rsplit("/", 1)
    source = (spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", bytes_per_batch)
              .parquet(f"{folder}/{name[:-1]}[{name[-1]}]"))  # as a pattern: it matches a file as well as a folder
    seen = _rows(source, id_col, text_col).groupBy("digest").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/digests/batch={number}")

    with settings(spark, STATE):
        (seen.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{home}/stream")
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{home}/digests").groupBy("digest").agg(F.min("at").alias("at"), F.max("n").alias("n"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of the table: ``id_col, keep_id, group_size, kept, text_sha256``."""
    table = spark.read.parquet(path)
    if not table.take(1):
        return table.select(F.col(id_col), F.col(id_col).alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                            F.lit(True).alias("kept"), F.lit("").alias("text_sha256")).limit(0)
    firsts = written(first_by_digest(spark, path, id_col, text_col), "exact-firsts")
    rows = _rows(table, id_col, text_col)
    # full bytes of the hits, a digest's rows dealt over SPREAD keys; copies fold
    # into one row per task before they meet, and a digest should have one text
    hits = firsts.where("n > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("at"), F.lit(SPREAD)).cast("int"))
    texts = (dealt.join(hits, ["digest", "part"], "left_semi").groupBy("digest", normal(F.col("text")).alias("body"))
             .agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n")))
    clash = written(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "exact-clash")
    out = rows.select("digest", "at").join(firsts.select("digest", F.col("at").alias("first"), "n"), "digest")
    if clash.take(1):
        # different texts under one digest: those rows are grouped by the text itself
        own = (texts.join(clash.select("digest"), "digest", "left_semi")
               .select("digest", "body", F.col("at").alias("first"), "n"))
        apart = (rows.join(clash.select("digest"), "digest", "left_semi").withColumn("body", normal(F.col("text")))
                 .join(own, ["digest", "body"]).select("digest", "at", "first", "n"))
        out = out.join(clash.select("digest"), "digest", "left_anti").unionByName(apart)
    return out.select(F.col("at.id").alias(id_col), F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
                      F.col("at").eqNullSafe(F.col("first")).alias("kept"), F.col("digest").alias("text_sha256"))
