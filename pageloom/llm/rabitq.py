"""Operator 7: embedding near-dedup by randomised-rotation binary codes.

A unit vector x is padded to ``BITS`` dimensions and turned by a random
rotation; its code is the signs of the result, o the unit vector of those
signs, and its stored correction factor f = <o, x>.  For another unit vector
y, <o, y> / f is an unbiased estimate of <x, y>, and the estimate is off by
at most EPSILON * sqrt((1 - f^2) / f^2 / (BITS - 1)) but for a vanishing part
of rotations.  Pairs whose upper bound reaches the threshold are recomputed
in double precision, and only that value decides.

Pairs to estimate come from the codes too: TABLES disjoint runs of KEY_BITS
code bits are hash tables, and pairs that share a key (and label) in some
table are estimated, in the first table where they meet.  At cosine 0.98 a
bit differs with probability 0.064, so a table misses a pair with
probability 1 - 0.936^12 = 0.55, and 16 tables miss 0.00006 of the pairs.

Equal vectors fold into one before that.  A key's vectors are compared in
blocks of ``BLOCK`` at most, block against block; a block pair emits the
number of links of each vector and a star of links, never all pairs.

Cases: a null label, a vector that is null, zero or of no length, or one
with a null or non-finite component links with nothing; vectors of different
length never link; repeated rows (equal in vector and label) are linked
vectors like any other; a null id is counted as a vector but never names a
component unless all its members are unnamed; an empty table gives an empty
table.  Only the three named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import components, python_ready, written
from pageloom.llm.simhash import stars

BITS = 256
KEY_BITS = 12
TABLES = 16
EPSILON = 4.0
#: Vectors of a block; a block pair compares this many squared.
BLOCK = 1024
#: Rows of a call that compares many cells, and pairs compared at a time.
CALL_ROWS, PAIRS = 4096, 16384

_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, seed: int) -> np.ndarray:
    """The first ``dim`` columns of a random rotation of ``max(BITS, dim)``
    dimensions: it turns a vector that is padded with zeros."""
    key = (dim, seed)
    if key not in _ROTATIONS:
        rng = np.random.default_rng(seed)
        q, r = np.linalg.qr(rng.standard_normal((max(BITS, dim), max(BITS, dim))))
        _ROTATIONS[key] = (q * np.sign(np.diag(r)))[:, :dim].copy()
    return _ROTATIONS[key]


def codes(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(turned, signs, factors)`` of unit vectors (one a row)."""
    turned = unit @ rotation(unit.shape[1], seed).T
    signs = np.where(turned >= 0, 1.0, -1.0)
    return turned, signs, (signs * turned).sum(axis=1) / np.sqrt(turned.shape[1])


def table_keys(signs: np.ndarray) -> np.ndarray:
    """The key of each vector in each table, from disjoint runs of its code."""
    bits = (signs[:, :KEY_BITS * TABLES] > 0).reshape(len(signs), TABLES, KEY_BITS)
    return (bits @ (1 << np.arange(KEY_BITS))).astype(np.int32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of huge or tiny components stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def vector_links(vectors: DataFrame, threshold: float = 0.98, seed: int = 42, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``id_col, n_links, component_id, kept``."""
    python_ready(vectors)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(label_col).alias("label"))
    usable = (F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
              & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # classes of equal vectors under a label, named by a number of their own
    classes = (rows.where("usable").groupBy("label", "v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = written(classes, "vectors")

    def key(batches):
        for batch in batches:
            dims = np.array([len(x) for x in batch.column(1)])
            for dim in np.unique(dims).tolist():
                part = pa.Table.from_batches([batch.filter(pa.array(dims == dim))])
                keys = table_keys(codes(_units(_matrix(part.column("v"))), seed)[1])
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("node").to_numpy(), TABLES)),
                     pa.array(np.tile(np.arange(TABLES, dtype=np.int32), n)), pa.array(keys.reshape(-1)),
                     pa.array(np.full(n * TABLES, dim, np.int32))], ["node", "tab", "key", "dim"])

    keyed = written(classes.select("node", "v").mapInArrow(key, "node bigint, tab int, key int, dim int")
                    .join(classes.select("node", "label"), "node"), "vector-keys")
    group = ["label", "dim", "tab", "key"]
    sizes = written(keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select(*group, "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "vector-buckets")
    shared = keyed.join(sizes, group).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *group, "node", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    cells = cells.join(classes.select("node", "v", "copies"), "node")

    def compare(cell: pa.Table) -> pa.Table:
        unit = _units(_matrix(cell.column("v")))
        spot, i, j, mine, node, copies, tab = (
            cell.column(c).to_numpy() for c in ("spot", "i", "j", "mine", "node", "copies", "tab"))
        order = np.lexsort((node, mine, j, i, spot))
        spot, i, j, mine, node, copies, tab, unit = (
            x[order] for x in (spot, i, j, mine, node, copies, tab, unit))
        turned, signs, factors = codes(unit, seed)
        keys = table_keys(signs)
        turned, signs = turned.astype(np.float32), signs.astype(np.float32)
        bound = EPSILON * np.sqrt((1 - factors ** 2) / factors ** 2 / (turned.shape[1] - 1))
        # the rows of a block pair stand together, the first block's before the
        # second's: a row meets those after it, or if blocks differ the second's
        n = len(node)
        new = np.r_[True, (spot[1:] != spot[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        group = np.cumsum(new) - 1
        end = np.append(np.flatnonzero(new)[1:], n)[group]
        second = end - np.bincount(group, weights=mine == j, minlength=group[-1] + 1).astype(np.int64)[group]
        begin = np.where(i == j, np.arange(n) + 1, second)
        meets = np.where((i == j) | (mine == i), end - begin, 0)
        count, a, b = np.zeros(n, np.int64), [], []
        after = np.cumsum(meets)
        row = 0
        while row < n:
            to = max(row + 1, int(np.searchsorted(after, after[row] - meets[row] + PAIRS, side="right")))
            x = np.repeat(np.arange(row, to), meets[row:to])
            y = np.arange(len(x)) - np.repeat(after[row:to] - meets[row:to] - (after[row] - meets[row]), meets[row:to])
            y += np.repeat(begin[row:to], meets[row:to])
            row = to
            guess = np.einsum("ij,ij->i", turned[x], signs[y]) / np.sqrt(turned.shape[1]) / factors[y]
            near = guess + bound[y] >= threshold
            x, y = x[near], y[near]
            # a pair that met in an earlier table was counted there
            earlier = ((keys[x] == keys[y]) & (np.arange(TABLES) < tab[x][:, None])).any(axis=1)
            x, y = x[~earlier], y[~earlier]
            exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            x, y = x[exact], y[exact]
            np.add.at(count, x, copies[y])
            np.add.at(count, y, copies[x])
            a.append(node[x])
            b.append(node[y])
        a, b = stars(np.concatenate(a or [node[:0]]), np.concatenate(b or [node[:0]]))
        linked = np.flatnonzero(count)
        return pa.table({"node": np.concatenate([node[linked], a]),
                         "n": np.concatenate([count[linked], np.zeros(len(a), np.int64)]),
                         "low": pa.array(np.concatenate([np.full(len(linked), -1, np.int64), b]))})

    # many small cells are compared in one call
    met = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("blocks")), F.lit(0))).first()[0]
    spot = F.xxhash64(*group)
    calls = F.pmod(F.xxhash64(spot, "i", "j"), F.lit(met // CALL_ROWS + 1))
    found = written(cells.withColumn("spot", spot).withColumn("call", calls).groupBy("dim", "call").applyInArrow(
        compare, "node bigint, n bigint, low bigint"), "vector-links")
    counts = found.where("low < 0").groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(found.where("low >= 0").select(F.col("node").alias("a"), F.col("low").alias("b")),
                       "vector-components")
    joined = (classes.join(counts, "node", "left").join(parts, "node", "left")
              .select("label", "v", "low", "copies", F.coalesce("n", F.lit(0)).alias("n"),
                      F.coalesce("root", "node").alias("root")))
    lowest = joined.groupBy("root").agg(F.min("low").alias("component"))
    named = written(joined.join(lowest, "root").select(
        F.col("label").alias("l"), F.col("v").alias("w"), (F.col("n") + F.col("copies") - 1).alias("n"), "component"),
        "vector-named")
    same = F.col("usable") & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w"))
    out = rows.where("usable").join(named, same).select("id", "n", "component").unionByName(
        rows.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_links"),
                      F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
