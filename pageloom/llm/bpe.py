"""Operator 2: byte-level BPE encoding and decoding.

Each match of the split pattern is merged by a rank queue: one bucket per
merge rank holds the linked-list positions whose pair has that rank, a
three-level bitmap over the ranks finds the lowest non-empty bucket by
find-first-set, and entries whose pair has changed since they were filed are
skipped.  A match of n bytes takes O(n log n), so a text without a single
space is no special case.

Cases: a null text is the empty text and encodes to no ids; an id sequence
that is null decodes to no bytes; repeated rows give repeated rows; an empty
table gives an empty table.  Only the id and text columns are read, so
further columns of any name are ignored.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import python_ready
from pageloom.llm.splits import TextCoder

def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: lines of a base64 token, a space and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f) if tok}


class Merger:
    """Ids of one match of the split pattern.

    ``low``, ``mid`` and ``top`` are the bitmap: bit r of ``low`` says that
    rank r has a bucket, a bit of ``mid`` that a word of ``low`` is not zero,
    a bit of ``top`` the same of ``mid``.  All are zero between two matches.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        n_ranks = max(ranks.values(), default=0) + 1
        self.low, self.mid = [0] * ((n_ranks >> 6) + 1), [0] * ((n_ranks >> 12) + 1)

    def code(self, match: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return array("I", self.merge(match.encode())).tobytes()

    def merge(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n, get, low, mid, top, buckets = len(piece), ranks.get, self.low, self.mid, 0, {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        filed = [-1] * n  # the rank under which a position is filed now
        found = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        while True:
            for r, i in found:  # file positions under the ranks of their pairs
                filed[i] = r
                if r in buckets:
                    heappush(buckets[r], i)
                else:
                    buckets[r] = [i]
                    low[r >> 6] |= 1 << (r & 63)
                    mid[r >> 12] |= 1 << (r >> 6 & 63)
                    top |= 1 << (r >> 12)
            if not top:
                break
            # the lowest rank that has a bucket, and its leftmost position
            g = (top & -top).bit_length() - 1
            w = g << 6 | (mid[g] & -mid[g]).bit_length() - 1
            r = w << 6 | (low[w] & -low[w]).bit_length() - 1
            bucket, found = buckets[r], []
            i = heappop(bucket)
            if not bucket:
                del buckets[r]
                low[w] &= low[w] - 1
                if not low[w]:
                    mid[g] &= mid[g] - 1
                    if not mid[g]:
                        top &= top - 1
            if filed[i] != r:
                continue  # stale: the pair here has changed since
            gone = after[i]
            end = after[i] = after[gone]
            filed[i] = filed[gone] = -1
            if end < n:
                before[end] = i
                if (r := get(piece[i:after[end]])) is not None:
                    found.append((r, i))
            left = before[i]
            if left >= 0:
                filed[left] = -1
                if (r := get(piece[left:end])) is not None:
                    found.append((r, left))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:after[i]]])
            i = after[i]
        return out


#: One coder per worker process, for one rank file and pattern.
_CODERS: dict[tuple, TextCoder] = {}


def _coder(key: tuple, ranks) -> TextCoder:
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = TextCoder(key[1], Merger(ranks.value).code)
    return _CODERS[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: every whole text's ids as little-endian unsigned
    32-bit integers (binary, one row per row of ``docs``).  The ranks (one
    vocabulary, whose size does not depend on the data) are broadcast."""
    spark = python_ready(docs)
    ranks, key = spark.sparkContext.broadcast(read_ranks(ranks_path)), (ranks_path, pattern)

    def run(batches):
        enc = _coder(key, ranks)
        for batch in batches:
            for part in _slices(batch):
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("ids", T.BinaryType())]))


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, decoded``: the bytes that the ids stand for."""
    spark = python_ready(encoded)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        ranked = ranks.value
        tokens = [b""] * (max(ranked.values(), default=-1) + 1)
        for tok, rank in ranked.items():
            tokens[rank] = tok
        for batch in batches:
            for part in _slices(batch):
                out = [b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", dtype="<u4").tolist()))
                       for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    rows = encoded.select(id_col, ids_col)
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("decoded", T.BinaryType())]))


def _slices(batch: pa.RecordBatch, rows: int = 500):
    """Parts of a batch, so that a worker holds the results of few texts at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``id_col, ids, decoded`` in one pass over the texts: the ids, and the
    bytes decoded again from the ids alone."""
    spark = python_ready(docs)
    ranks, key = spark.sparkContext.broadcast(read_ranks(ranks_path)), (ranks_path, pattern)

    def run(batches):
        enc = _coder(key, ranks)
        tokens = {rank: tok for tok, rank in ranks.value.items()}
        for batch in batches:
            for part in _slices(batch):
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                out = [b"".join(map(tokens.__getitem__, np.frombuffer(x, dtype="<u4").tolist())) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(out, pa.binary())],
                    [id_col, "ids", "decoded"])

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("ids", T.BinaryType()),
                                              T.StructField("decoded", T.BinaryType())]))


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of :func:`round_trip`'s rows."""
    return coded.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_tokenizer() -> tuple[str, str]:
    """Rank file and split pattern of the public 50k vocabulary."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN
