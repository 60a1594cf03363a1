"""The corpus pipeline: documents to token ids.

Language ID, line dedup, SimHash near-dedup, mixing and byte-level BPE, each
an operator of ``pageloom.llm``; a stage's table is written as Parquet and
read again as the next one's documents.

Every stage takes whatever columns its documents have beside those it reads
and (but for the last) hands all of them on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import bpe, languages, lines, mixing, simhash
from pageloom.llm.common import row_key, table, written

#: SQL can't express the text model, the hashes of the shingles or the merges;
#: tests/llm/test_pipeline.py checks every stage on a small table.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (operator 5); the rest go."""
    model = languages.fit(docs)
    return languages.keep(docs, model, declared_col="lang", host_col="source")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that occur earlier (operator 9)."""
    rows = lines.dedup_lines(docs)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 8), the one with
    the smallest identifier."""
    return simhash.keep(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them (operator 3)."""
    keyed = docs.withColumn("__key", row_key("doc_id", "text"))
    mixed = mixing.mix(keyed, table(spark, sf_dir, "labels"), row_col="__key").where("times > 0")
    # rows that repeat share a key; together they are taken as often as all of them
    times = written(mixed.groupBy(F.col("__key").alias("__row")).agg(F.sum("times").cast("int").alias("__times")), "pipeline-times")
    taken = keyed.dropDuplicates(["__key"]).join(times, F.col("__key") == F.col("__row"))
    again = taken.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return again.select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text decoded from them (operator 2), as digests."""
    return bpe.digests(bpe.round_trip(docs, *bpe.default_tokenizer()))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
