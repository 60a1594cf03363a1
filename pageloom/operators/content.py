"""Content-addressed store of binary bodies (SNK-6, IMG-1, S-20).

A store is a folder with two tables: ``content`` (``digest, body``, one row
per different body, partitioned by the digest's first hexadecimal digit) and
``index`` (``source_url, category, md5, digest, n_bytes``, one row per URL).
Bodies are written before the index rows that name them, and neither is
written again where it is there: a run that broke off is simply repeated.
One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.binary import image_kind
from pageloom.operators.frontier import unseen
from pageloom.session import materialize
from pageloom.sources.locator import fetch, located

INDEX = "source_url string, category string, md5 string, digest string, n_bytes int"
CONTENT = "digest string, body binary, prefix string"


def _table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{name}"
    w = spark.createDataFrame([], schema).write.mode("ignore")  # an empty table the first time
    (w.partitionBy("prefix") if name == "content" else w).parquet(path)
    return spark.read.schema(schema).parquet(path)


def open_store(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The tables ``(index, content)`` of the store in ``root``."""
    return _table(spark, root, "index", INDEX), _table(spark, root, "content", CONTENT)


def wanted_images(tours: DataFrame) -> DataFrame:
    """The ``http://`` image URLs of rows still without an image id, once each."""
    return (tours.where(F.col("head_image").startswith("http://") & (F.col("image_id") <= 0))
            .select(F.col("head_image").alias("source_url")).distinct())


def store_images(urls: DataFrame, bodies: DataFrame, root: str, category: str, min_bytes: int = 20) -> None:
    """IMG-1: the images of ``urls(source_url)`` that the store in ``root``
    lacks, from ``bodies(url, body)``, a table of Parquet files; bodies of
    ``min_bytes`` or less, or without an image signature, are not stored.  Of
    several bodies of one URL the one with the smallest digest counts.

    The joins (new URLs, their places, digests already stored) move URLs,
    places and digests only; bodies are read where they lie, once to be signed
    and, if their content is new, once more to be written."""
    spark = urls.sparkSession
    index, content = open_store(spark, root)
    fresh = unseen(urls.select("source_url").distinct(), index, key="source_url")
    at = fresh.join(located(bodies, F.col("url").alias("source_url")), "source_url")
    read = fetch(at, bodies, "body")
    signed = (read.where((F.octet_length("body") > min_bytes) & image_kind("body").isNotNull())
              .select("source_url", "file", "row", F.md5("body").alias("md5"), F.sha2("body", 256).alias("digest"),
                      F.octet_length("body").cast("int").alias("n_bytes")))
    signed = materialize(signed, "signed")
    rows = signed.groupBy("source_url").agg(F.min(F.struct("digest", "md5", "n_bytes", "file", "row")).alias("s"))
    rows = materialize(rows.select("source_url", "s.*"), "index-rows")

    new = rows.groupBy("digest").agg(F.min(F.struct("file", "row")).alias("at")).select("digest", "at.*")
    new = unseen(new, content, key="digest")
    stored = fetch(new, bodies, "body").select("digest", "body", F.substring("digest", 1, 1).alias("prefix"))
    stored.write.mode("append").partitionBy("prefix").parquet(f"{root.rstrip('/')}/content")
    (rows.select("source_url", F.lit(category).alias("category"), "md5", "digest", "n_bytes")
     .write.mode("append").parquet(f"{root.rstrip('/')}/index"))


def read_back(spark: SparkSession, root: str) -> DataFrame:
    """The stored images, signed anew from the stored bytes: ``source_url,
    category, md5, n_bytes``."""
    index, content = open_store(spark, root)
    bytes_ = content.select("digest", F.md5("body").alias("md5"), F.octet_length("body").cast("int").alias("n_bytes"))
    return index.select("source_url", "category", "digest").join(bytes_, "digest").drop("digest")
