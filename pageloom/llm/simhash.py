"""Operator 8: SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has 64 bits, one by the majority of the hashes of
its word shingles.  Two fingerprints that differ in at most r bits are found
by masks: every bit position gets a vector of r + 1 bits, and for each of the
2^(r+1) - 1 non-zero vectors there is a mask of the positions whose vector
has an odd product with it.  The vectors of r positions always leave some
non-zero vector that is orthogonal to all of them, so for any r differing
bits some mask covers none of them: every pair within the radius agrees
under a mask, and none is lost.

Fingerprints, not documents, are joined: copies fold into one.  Fingerprints
under one masked value are compared in blocks of ``BLOCK`` at most, block
against block, and a block pair emits one link per fingerprint and block (to
the smallest it reaches there), so a large group never emits all its pairs.

Cases: a null text is the empty text, whose fingerprint is zero and is linked
like any other; fewer words than a shingle are one shingle; repeated rows are
copies; a null identifier is the largest, and rows without one are told apart
by their text; an empty table gives an empty table.  Only the id and text
columns are read.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import components, python_ready, row_key, written

#: Fingerprints of a block; a block pair compares this many squared.
BLOCK = 1024
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of XXH64 (seed 42) over the shingles, as an unsigned integer."""
    words = (text or "").encode().lower().split()  # lower() and split() of bytes know ASCII alone
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        block = hashes[i:i + 8192]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``key`` (128 bits that stand for id and text) and ``fp`` (the
    fingerprint as a signed 64-bit integer) per row."""
    python_ready(docs)
    key = row_key(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), key["x"].alias("x"), key["y"].alias("y"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(3).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps)], ["id", "x", "y", "fp"])

    fields = [*rows.schema.fields[:3], T.StructField("fp", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields)).select("id", F.struct("x", "y").alias("key"), "fp")


def masks(radius: int, seed: int = SEED) -> list[int]:
    """The covering masks as signed 64-bit integers.  The positions' vectors
    are shuffled multiples of all non-zero ones, so that masks are of like size."""
    dim = radius + 1
    vectors = [1 + i % ((1 << dim) - 1) for i in range(64)]
    random.Random(seed).shuffle(vectors)
    out = []
    for v in range(1, 1 << dim):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (``fp``) whose closure is
    that of all pairs within ``radius`` bits."""
    python_ready(prints)
    tables = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
                       for i, m in enumerate(masks(radius))])
    keyed = prints.select("fp", F.inline(tables))
    sizes = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = written(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "simhash-sizes")
    # a group of several blocks is copied block times, each copy meeting another block
    shared = written(keyed.join(sizes, ["mask", "value"]), "simhash-shared")
    mine = F.pmod(F.xxhash64("fp", "mask"), F.col("blocks")).cast("int")
    cells = shared.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("fp", "mask", "value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         "mine")

    def compare(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        i, j, mine = (group.column(c).to_numpy() for c in ("i", "j", "mine"))
        left, right = np.sort(fps[mine == i[0]]), np.sort(fps[mine == j[0]])
        a, b = [], []
        for row in range(0, len(left), 256):
            near = np.bitwise_count(left[row:row + 256, None] ^ right[None, :]) <= radius
            at, to = np.nonzero(near)
            a.append(left[row + at])
            b.append(right[to])
        a, b = stars(np.concatenate(a or [left[:0]]), np.concatenate(b or [left[:0]]))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return cells.groupBy("mask", "value", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected part of the pairs: each node with its part's smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        low = np.minimum(low, low[low])
        if (low == root).all():
            break
        root = low
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, fingerprint`` (16 hex digits),
    ``component_id``, the smallest identifier that links reach, ``key`` and
    ``kept``: whether id and text are those of the row that stays."""
    prints = written(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    at = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("key"))
    classes = written(prints.groupBy("fp").agg(F.min(at).alias("low")), "simhash-classes")
    parts = components(links(classes.select("fp"), radius), "simhash-links")
    rooted = classes.join(parts, classes["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("first"))
    named = written(rooted.join(lowest, "root").select("fp", "first"), "simhash-named")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"), "key", (F.col("key") == F.col("first.key")).alias("kept"))


def keep(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the smallest by
    identifier (unnamed last) and then by a hash of the text; of rows equal
    in both, any one."""
    groups = near_duplicates(docs, shingle, radius, id_col, text_col)
    stay = written(groups.where("kept").select(F.col("key").alias("__stay")).distinct(), "simhash-stay")
    keyed = docs.withColumn("__key", row_key(id_col, text_col))
    kept = keyed.join(stay, F.col("__key") == F.col("__stay"), "left_semi").dropDuplicates(["__key"])
    return kept.drop("__key")
