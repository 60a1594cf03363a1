"""Operator 5: language ID by Bayesian evidence fusion.

The evidence on a document is its text, the language its markup declares, the
suffix of its address, and its host.  Text likelihoods come from hashed byte
trigrams, fitted on a bounded sample of labelled rows (``SAMPLE`` per
language, those of the lowest hashes); every label that is a language tag is
a candidate, reduced to its primary subtag (``en-US`` counts for ``en``).  The rest is learned from all rows
without labels, by grouped sums of the text's posteriors: how often a
language declares what, under which suffix it stands, and which languages a
host has, smoothed towards its domain and that towards all rows.  A row's own
part is taken out of the sums before they judge it.  The product of all
gives the posterior; ``und`` (undetermined) is a language of its own whose
trigrams are all equally likely.

A row is rejected if its text has no letter (of any script), or if ``und`` or no language at
all has a posterior of ``LEAST``.

Cases: a null or empty text has no letter and is rejected; a null declared
language, suffix or host is a value like any other; ties go to the language
that comes first by name; repeated rows are judged alike; an empty table
gives an empty table; without labelled rows everything is ``und``.  Only the
named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import python_ready, row_key, shuffle_partitions, written

#: Bounds of what is fitted: rows per language, trigram buckets.  The model has
#: 64 KB per language, so it is bounded by the number of language tags in use.
SAMPLE, BUCKETS = 400, 1 << 14
#: Weight of the equal distribution in a language's trigrams, and of a trigram
#: in the posterior (trigrams overlap, so three of them say about one thing).
FLAT, TRIGRAM = 0.1, 1 / 3
#: Rows that a parent's distribution counts for in its child's.
PRIOR_ROWS = 5.0
#: Prior weight of ``und`` against each language, and the least posterior.
UNDETERMINED, LEAST = 1e-3, 0.5
UND = "und"


def _trigrams(text: str | None) -> tuple[np.ndarray, bool]:
    """Buckets of the lower-case text's byte trigrams, and whether it has a letter."""
    low = (text or "").lower()
    data = np.frombuffer(low.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    letters = any(map(str.isalpha, low))
    if len(data) < 3:
        return np.empty(0, np.int64), letters
    mixed = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), letters


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang"):
    """``(languages, table)``: names, and log probabilities per bucket and
    language, the last column of ``und``.  At most SAMPLE rows per language
    are read for it, and BUCKETS sums per language return to the driver.  A
    label whose primary subtag has not 2 to 8 letters is no label."""
    python_ready(labelled)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), _primary(F.col(label_col)).alias("l")).where(
        F.col("l").rlike("^[a-z]{2,8}$") & (F.col("l") != UND))
    place = F.row_number().over(Window.partitionBy("l").orderBy("draw", "id"))
    chosen = rows.select("id", "l", F.xxhash64("id", F.lit(5)).alias("draw")).withColumn("place", place).where(
        F.col("place") <= SAMPLE).select(F.col("id").alias("__id"), F.col("l").alias("__l")).distinct()
    of_row = F.col("id").eqNullSafe(F.col("__id")) & (F.col("l") == F.col("__l"))
    sample = rows.join(F.broadcast(chosen), of_row).select("l", "t")  # at most SAMPLE ids per language

    def count(batches):
        for batch in batches:
            sums = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(_trigrams(text)[0], minlength=BUCKETS)
                sums[name] = sums[name] + found if name in sums else found
            for name, found in sums.items():
                at = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at),
                                                  pa.array(found[at].astype(np.int64))], ["l", "b", "n"])

    sums = sample.mapInArrow(count, "l string, b bigint, n bigint").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(sums["l"]))
    if not names:
        return [], np.full((BUCKETS, 1), -np.log(BUCKETS), np.float32)
    counts = np.zeros((BUCKETS, len(names)))
    counts[sums["b"].to_numpy(), sums["l"].map({n: i for i, n in enumerate(names)}).to_numpy()] = sums["n"].to_numpy()
    shares = counts / np.maximum(counts.sum(axis=0), 1)
    table = np.log((1 - FLAT) * shares + FLAT / BUCKETS)
    return names, np.column_stack([table, np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32)


def _primary(declared: Column) -> Column:
    """``en`` of ``en-US`` or ``EN_gb``."""
    return F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), r"^\s*([A-Za-z]*)", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def text_scores(rows: DataFrame, model) -> DataFrame:
    """``rows`` (``text`` and others) with, instead of the text, ``ll`` (log
    likelihood per language) and ``letters`` (whether it has any)."""
    python_ready(rows)
    shared = rows.sparkSession.sparkContext.broadcast(model[1])  # BUCKETS numbers per language
    rows = rows.select("text", *[c for c in rows.columns if c != "text"])

    def run(batches):
        logs = shared.value
        for batch in batches:
            scores, letters = [], []
            for text in batch.column(0).to_pylist():
                grams, n = _trigrams(text)
                score = np.zeros(logs.shape[1])
                for i in range(0, len(grams), 65536):
                    score += logs[grams[i:i + 65536]].sum(axis=0, dtype=np.float64)
                scores.append(score * TRIGRAM)
                letters.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.list_(pa.float64())), pa.array(letters, pa.bool_())],
                [*batch.schema.names[1:], "ll", "letters"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField("ll", T.ArrayType(T.DoubleType())),
                                              T.StructField("letters", T.BooleanType())]))


def _normalised(logs: Column) -> Column:
    """Probabilities from an array of logs."""
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, x: a + x))


_zip = F.zip_with


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = None,
             url_col: str | None = None, host_col: str | None = None) -> DataFrame:
    """``id_col, language, probability, kept`` and ``key`` (for :func:`keep`),
    one row per row.  The host comes from ``host_col`` or the address.  Texts
    are read where they lie; only scores are shuffled."""
    names = [*model[0], UND]
    size = len(names)
    none = F.lit("")
    used = [c for c in (id_col, text_col, declared_col, url_col, host_col) if c]
    url = F.col(url_col) if url_col else F.lit(None).cast("string")
    host = F.coalesce(F.col(host_col).cast("string"), none) if host_col else host_of(url)
    rows = docs.select(F.col(id_col).alias("id"), row_key(*used).alias("key"), F.col(text_col).alias("text"),
                       _primary(F.col(declared_col) if declared_col else F.lit(None).cast("string")).alias("declared"),
                       F.regexp_extract(host_of(url), r"([^.]*)$", 1).alias("suffix"), host.alias("host"),
                       F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1).alias("domain"))
    scored = text_scores(rows, model)
    flat = F.array(*[F.lit(0.0)] * (size - 1), F.lit(float(np.log(UNDETERMINED))))
    known = written(scored.withColumn("own", _normalised(_zip(F.col("ll"), flat, lambda a, b: a + b))), "lang-own")
    # a row's scores are few bytes and much work, so the scan's own splits would be too large
    known = known.repartition(shuffle_partitions(known.sparkSession))

    def sums(*by: str) -> DataFrame:
        named = {f"s{i}": F.sum(F.col("own")[i]) for i in range(size)}
        return known.groupBy(*by).agg(*[v.alias(k) for k, v in named.items()]).select(
            *by, F.array(*[F.col(k) for k in named]).alias("sums"))

    total = sums().first()["sums"]  # one number per language
    judged = known.withColumn("all_sums", F.array(*[F.lit(float(x or 0.0)) for x in total]))
    for by in ("declared", "suffix", "domain", "host"):
        part = written(sums(by).withColumnRenamed("sums", f"{by}_sums"), f"lang-{by}")
        judged = judged.join(part, by)
    own = F.col("own")

    def others(name: str) -> Column:
        return _zip(F.col(f"{name}_sums"), own, lambda s, o: F.greatest(s - o, F.lit(0.0)))

    def total_of(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def child(name: str, parent: Column) -> Column:
        counts = others(name)
        return _zip(counts, parent, lambda c, p: (c + PRIOR_ROWS * p) / (total_of(counts) + PRIOR_ROWS))

    everything = others("all")
    uniform = F.transform(everything, lambda c: (c + 1.0 / size) / (total_of(everything) + 1.0))
    host_prior = child("host", child("domain", uniform))

    def given_language(name: str) -> Column:
        """P(value | language), smoothed towards the value's share of all rows."""
        counts = others(name)
        share = (total_of(counts) + 0.5) / (total_of(everything) + 1.0)
        return _zip(counts, everything, lambda c, n: (c + PRIOR_ROWS * share) / (n + PRIOR_ROWS))

    judged = judged.withColumn("prior", host_prior).withColumn("said", given_language("declared")).withColumn(
        "stood", given_language("suffix"))
    logs = F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                       lambda i: F.col("ll")[i] + F.ln(F.col("prior")[i]) + F.ln(F.col("said")[i]) + F.ln(F.col("stood")[i]))
    judged = judged.withColumn("post", _normalised(logs)).withColumn("best", F.array_max("post"))
    best = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("post", F.col("best")).cast("int"))
    kept = F.col("letters") & (best != UND) & (F.col("best") >= LEAST)
    return judged.select(F.col("id").alias(id_col), F.when(kept, best).otherwise(F.lit(UND)).alias("language"),
                         F.col("best").alias("probability"), kept.alias("kept"), "key")


def keep(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = None,
         url_col: str | None = None, host_col: str | None = None) -> DataFrame:
    """``docs`` without the rows that :func:`identify` rejects."""
    verdict = identify(docs, model, id_col, text_col, declared_col, url_col, host_col)
    # the verdict is written before it is filtered: a filter would be pushed
    # below the posterior and copy its expression into every use
    judged = written(verdict.select("key", "kept"), "lang-verdict")
    rejected = judged.where(~F.col("kept")).select(F.col("key").alias("__rejected")).distinct()
    used = [c for c in (id_col, text_col, declared_col, url_col, host_col) if c]
    return docs.join(rejected, row_key(*used) == F.col("__rejected"), "left_anti")
