"""Operator 12: cross-tokenizer alignment with inverted pair bitmaps.

A text is encoded by two tokenizers.  Where a token of each ends at the same
byte, both sequences are cut, which gives groups of tokens that spell the same
bytes; two tokens whose bytes overlap are linked.  How often a pair of ids is
linked in the corpus says how well they correspond, and every document is
scored by its links' counts.

The counts come from an index that is inverted by pair.  Documents are
numbered within blocks; per pair and block the index holds bitmaps of the
documents, one per binary digit of the number of links (multiplicity planes),
compressed as a list of set bits where that is smaller.  A block's bitmaps are
merged by OR as documents are read.  The bits set in the OR of a pair's planes
are its documents, those of plane ``k`` stand for ``2**k`` links each, and
blocks share no document, so a pair's counts are sums over its blocks.  Then
every pair's score goes back along its postings: a block's bitmaps are decoded
and add the score to the documents whose bits are set.

A block ends at ``BLOCK`` documents or ``entries`` document-pair entries, which
bounds what a task holds at a time and what the group that scores a block
reads.  Pairs are spread over the tasks by hash; a pair has one row per block,
however many links it has.  Only a table with one row per id of the second
vocabulary is broadcast.

Both tokenizers begin a token at a single space between two characters that
are no white space, so a text is cut there and the alignment of a part (a word,
mostly) is remembered within bounds; this has no effect on results.

Cases: null and empty texts, and those whose bytes either tokenizer's tokens do
not spell, have no tokens and zeros; strings of special tokens are plain text;
repeated rows and ids count as often as they occur; a null identifier is
handed through; an empty table gives an empty table; of the input only the
two named columns are read.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import python_ready, written

#: Bounds of a block: documents (bits of a bitmap), entries (set bits of all its pairs).
BLOCK, ENTRIES = 1 << 16, 3_000_000
#: Parts that are remembered, and the longest of them in characters.
REMEMBER, SHORT = 250_000, 64

_cut_at_spaces = re.compile(r"(?<=\S) (?=\S)").split


class Aligner:
    """Alignments of texts by two tokenizers, ``tokenizers`` JSON (byte-level
    BPE) and a ``sentencepiece`` model that adds a space before a text."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.first = Tokenizer.from_str(tokenizer_json)
        self.first.encode_special_tokens = True  # their strings in a text are ordinary text
        self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256 and up
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.letters = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        byte_of = {chr(b): b for b in plain} | {c: b for b, c in self.letters.items()}
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                        for p in pieces]
        self.digits = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        # a Latin word and the marks after it are one match each of the split pattern, which the model codes by itself
        self.by_match = "ByteLevel(add_prefix_space=False" in repr(self.first.pre_tokenizer) and self.first.normalizer is None
        self.marks: dict[str, list[int]] = {"": []}
        self.known: dict[str, tuple | None] = {}

    def _match(self, match: str) -> list[int]:
        return [t.id for t in self.first.model.tokenize(match.encode().decode("latin-1").translate(self.letters))]

    def _first(self, part: str) -> list[int] | None:
        """Ids by the first tokenizer of a space and a Latin word with marks after it; None of any other part."""
        word = part.rstrip(".,;:!?")
        if not self.by_match or not word.isalpha() or max(word) >= "\u0250":
            return None
        marks = part[len(word):]
        if marks not in self.marks:
            if len(self.marks) > 1000:
                self.marks = {"": []}
            self.marks[marks] = self._match(marks)
        return self._match(" " + word) + self.marks[marks]

    def _align(self, part: str, a: list[int], b: list[int]) -> tuple | None:
        """``tokens of a, of b, groups, groups' text, pairs`` of a part, or
        None if the tokens don't spell it with a space before it."""
        spells_a, spells_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        spelled = (" " + part).encode()
        if b"".join(spells_b) != spelled or b"".join(spells_a) != spelled:
            return None
        digits, pairs, groups, i, j = self.digits, [], [], 0, 0
        end_a, end_b, high, low = len(spells_a[0]), len(spells_b[0]), a[0] << 32, b[0]
        ids_a, ids_b = digits[a[0]], digits[low]
        while True:
            pairs.append(high | low)
            if end_a < end_b:
                i += 1
                end_a += len(spells_a[i])
                high = a[i] << 32
                ids_a = f"{ids_a},{digits[a[i]]}"
            elif end_b < end_a:
                j += 1
                end_b += len(spells_b[j])
                low = b[j]
                ids_b = f"{ids_b},{digits[low]}"
            else:
                groups.append(f"{ids_a}|{ids_b}")
                i, j = i + 1, j + 1
                if i == len(a):
                    return len(a), len(b), len(groups), ";".join(groups), array("q", pairs).tobytes()
                end_a, end_b, high, low = end_a + len(spells_a[i]), end_b + len(spells_b[j]), a[i] << 32, b[j]
                ids_a, ids_b = digits[a[i]], digits[low]

    def _learn(self, parts: set[str], into: dict) -> None:
        wanted = sorted(parts)
        coded_a = [self._first(p) for p in wanted]
        others = [p for p, ids in zip(wanted, coded_a, strict=True) if ids is None]
        rest = iter(self.first.encode_batch([" " + p for p in others], add_special_tokens=False))
        for p, a, b in zip(wanted, coded_a, self.second.encode(wanted, num_threads=1), strict=True):
            into[p] = self._align(p, next(rest).ids if a is None else a, b)

    def align(self, texts: list[str | None]) -> list[list[tuple] | None]:
        """Per text the alignments of its parts in order; None if it has none."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        known, cut = self.known, [t.split(" ") if t else [] for t in texts]
        new = set().union(*cut).difference(known)
        # beside other white space a space need not begin a token: such texts are cut with more care
        odd = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        once: dict = {}
        if odd:
            for k, parts in enumerate(cut):
                if not odd.isdisjoint(parts):
                    cut[k] = _cut_at_spaces(texts[k])
            new = set().union(*cut).difference(known)
        kept = {p for p in new if len(p) <= SHORT and not p[0].isspace() and not p[-1].isspace()}
        self._learn(kept, known)
        self._learn(new - kept, once)
        found = [list(map(known.get, parts, map(once.get, parts))) for parts in cut]
        return [None if not parts or None in parts else parts for parts in found]


_ALIGNERS: dict[tuple, Aligner] = {}

#: What an alignment says of a document.
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _documents(batches, aligner: Aligner) -> Iterator[tuple]:
    """``ids, counts, groups, pairs`` of slices of documents; ``pairs`` are
    the distinct pairs of each and how often it has them."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            some = batch.slice(k, 256)
            counts, groups, pairs = [], [], []
            for parts in aligner.align(some.column(1).to_pylist()):
                if parts is None:
                    counts.append((0, 0, 0, 0))
                    groups.append("")
                    pairs.append((np.empty(0, np.int64), np.empty(0, np.int64)))
                    continue
                *numbers, said, links = zip(*parts, strict=True)
                a, b, cuts = map(sum, numbers)
                counts.append((a, b, cuts, a + b - cuts))
                groups.append(";".join(said))
                pairs.append(np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True))
            yield some.column(0), counts, groups, pairs


def bitmaps(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, size: int) -> dict:
    """The postings of a block of ``size`` documents, from its entries: per
    pair, in order, ``docs`` and ``links`` (popcounts) and ``planes``: bitmap
    ``k`` has the documents whose number of links has the binary digit ``k``,
    as ``span`` bytes or, where that is shorter, as a list of 16-bit numbers."""
    span = -(-size // 16) * 2
    order = np.argsort(pairs, kind="stable")  # documents come in order
    pairs, docs, times = pairs[order], docs[order], times[order]
    starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(pairs)]))
    planes = int(times.max()).bit_length() if len(times) else 0
    bits = [np.flatnonzero(times >> k & 1) for k in range(planes)]
    entry = np.concatenate(bits) if bits else np.empty(0, np.int64)
    plane = np.repeat(np.arange(planes), [len(b) for b in bits])
    by_row = np.lexsort((plane, row[entry]))  # stable: documents stay in order
    entry, plane = entry[by_row], plane[by_row]
    # a row has all planes up to its highest, empty ones included
    highest = np.zeros(len(starts), np.int64)
    np.maximum.at(highest, row[entry], plane)
    first = np.r_[0, np.cumsum(highest + 1)]
    place = first[row[entry]] + plane
    ones = np.bincount(place, minlength=int(first[-1]))
    ends = np.cumsum(ones)
    dense = 2 * ones >= span
    numbers, chunks, done = docs[entry].astype("<u2"), [], 0
    for i in np.flatnonzero(dense).tolist():
        chunks.append(numbers[done:ends[i] - ones[i]].tobytes())
        field = np.zeros(span * 8, np.uint8)
        field[numbers[ends[i] - ones[i]:ends[i]]] = 1
        chunks.append(np.packbits(field, bitorder="little").tobytes())
        done = ends[i]
    chunks.append(numbers[done:].tobytes())
    offsets = np.r_[0, np.cumsum(np.where(dense, span, 2 * ones))].astype(np.int32)
    values = pa.BinaryArray.from_buffers(pa.binary(), len(ones), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(chunks))])
    links = np.add.reduceat(ones << (np.arange(len(ones)) - np.repeat(first[:-1], highest + 1)), first[:-1]) if len(starts) else ones
    return {"pair": pa.array(pairs[starts]), "docs": pa.array(np.bincount(row, minlength=len(starts)), pa.int64()),
            "links": pa.array(links, pa.int64()), "span": span,
            "planes": pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)}


def set_bits(planes: pa.ListArray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, document, weight`` of every set bit of a block's bitmaps; a bit
    of plane ``k`` weighs ``2**k``."""
    values = planes.flatten()
    sizes = pc.binary_length(values).to_numpy()
    per_row = np.diff(planes.offsets.to_numpy())
    row = np.repeat(np.arange(len(per_row)), per_row)
    weight = 1 << (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row))
    data = b"".join(values.to_pylist())
    numbers, part = np.frombuffer(data, "<u2"), np.repeat(np.arange(len(sizes)), sizes // 2)
    dense = sizes == span
    listed = ~dense[part]
    parts, docs = [part[listed]], [numbers[listed].astype(np.int64)]
    for i in np.flatnonzero(dense).tolist():
        there = np.flatnonzero(np.unpackbits(np.frombuffer(values[i].as_py(), np.uint8), bitorder="little"))
        parts.append(np.full(len(there), i))
        docs.append(there)
    part = np.concatenate(parts)
    return row[part], np.concatenate(docs), weight[part]


def _vocabularies(spark, tokenizer_path: str, model_path: str):
    with open(tokenizer_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        return spark.sparkContext.broadcast((f.read(), g.read()))  # their size does not depend on the data


def _aligner(key: tuple, files) -> Aligner:
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*files.value)
    return _ALIGNERS[key]


def alignments(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, groups`` (``a1,a2|b1;a3|b2,b3``),
    ``links`` (the distinct pairs ``a, b`` with their ``times``)."""
    spark, key = python_ready(docs), (tokenizer_path, model_path)
    files, rows = _vocabularies(spark, *key), docs.select(id_col, text_col)
    link = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())])

    def run(batches):
        for ids, counts, groups, pairs in _documents(batches, _aligner(key, files)):
            links = [[{"a": p >> 32, "b": p & 0xFFFFFFFF, "times": n} for p, n in zip(*map(np.ndarray.tolist, x), strict=True)] for x in pairs]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)), pa.array(groups, pa.string()),
                 pa.array(links, pa.list_(link))], [id_col, *COUNTS, "groups", "links"])

    links = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                      T.StructField("times", T.LongType())]))
    return rows.mapInArrow(run, T.StructType([rows.schema[0], *(T.StructField(c, T.LongType()) for c in COUNTS),
                                              T.StructField("groups", T.StringType()), T.StructField("links", links)]))


#: Fields of the index beside the identifier: of a document's row, then of a pair's.
_OF_DOC = [("no", pa.int32()), *((c, pa.int64()) for c in COUNTS), ("groups", pa.string())]
_OF_PAIR = [("pair", pa.int64()), ("docs", pa.int64()), ("links", pa.int64()), ("span", pa.int32()), ("planes", pa.list_(pa.binary()))]


def index(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
          groups: Callable[[Column], Column] = lambda c: c, entries: int = ENTRIES) -> DataFrame:
    """The written index: a row per document (``block, no``, the counts of
    :func:`alignments`, and what ``groups`` makes of the groups' text) and a
    row per pair and block (``block, pair, docs, links, span, planes``)."""
    spark, key = python_ready(docs), (tokenizer_path, model_path)
    files, rows = _vocabularies(spark, *key), docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        fields = [("id", None), ("block", pa.int64()), *_OF_DOC, *_OF_PAIR]
        held, n_docs, n_entries, id_type = [], 0, 0, None

        def rows_of(n: int, columns: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[f] if f in columns else pa.nulls(n, t or id_type) for f, t in fields], [f for f, _ in fields])

        def postings():
            found = bitmaps(*(np.concatenate(x) for x in zip(*held, strict=True)), n_docs)
            for k in range(0, len(found["pair"]), 20000):
                some = {c: v.slice(k, 20000) for c, v in found.items() if c != "span"}
                n = len(some["pair"])
                yield rows_of(n, some | {"block": pa.array(np.full(n, block)), "span": pa.array(np.full(n, found["span"], np.int32))})

        for ids, counts, texts, pairs in _documents(batches, _aligner(key, files)):
            id_type, n = ids.type, len(ids)
            if n_docs + n > BLOCK or n_entries > entries:
                yield from postings()
                block, held, n_docs, n_entries = block + 1, [], 0, 0
            yield rows_of(n, {"id": ids, "block": pa.array(np.full(n, block)), "groups": pa.array(texts, pa.string()),
                              "no": pa.array(np.arange(n_docs, n_docs + n, dtype=np.int32)),
                              **{c: pa.array([x[i] for x in counts], pa.int64()) for i, c in enumerate(COUNTS)}})
            for k, (found, times) in enumerate(pairs):
                held.append((found, np.full(len(found), n_docs + k, np.int32), times.astype(np.int32)))
                n_entries += len(found)
            n_docs += n
        if n_entries:
            yield from postings()

    schema = T.StructType([T.StructField("id", rows.schema[0].dataType), T.StructField("block", T.LongType()),
                           T.StructField("no", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("groups", T.StringType()), T.StructField("pair", T.LongType()),
                           T.StructField("docs", T.LongType()), T.StructField("links", T.LongType()),
                           T.StructField("span", T.IntegerType()), T.StructField("planes", T.ArrayType(T.BinaryType()))])
    made = rows.mapInArrow(run, schema)
    return written(made.withColumn("groups", groups(F.col("groups"))), "pair-index")


def pair_scores(indexed: DataFrame) -> DataFrame:
    """``pair, a, b, docs, links`` (counts over the corpus) and ``best``
    (whether no other pair of ``b`` has more links) of every pair."""
    counts = written(indexed.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links")),
                     "pair-counts")
    counts = counts.select("pair", F.shiftright("pair", 32).cast("int").alias("a"),
                           F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "docs", "links")
    top = counts.groupBy(F.col("b").alias("id")).agg(F.max("links").alias("top"))
    # one row per id of a vocabulary: its size does not depend on the data
    return counts.join(F.broadcast(top), F.col("b") == F.col("id")).select(
        "pair", "a", "b", "docs", "links", (F.col("links") == F.col("top")).alias("best"))


def document_scores(indexed: DataFrame, scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document ``id_col``, its counts and groups, ``n_best`` (its links
    whose pair is ``best``) and ``count_sum`` (the sum of its links' counts),
    from the scores that its block's postings return."""
    # only keys meet the scores by pair; the bitmaps move once, to their block
    keys = indexed.where("pair is not null").select("pair", "block")
    returned = keys.join(scores.select(F.col("pair").alias("p"), F.col("links").alias("count"), "best"), F.col("pair") == F.col("p")).select(
        F.col("block").alias("of"), F.col("pair").alias("of_pair"), "count", "best")
    rows = indexed.select("block", "no", "id", *COUNTS, "groups", "pair", "span", "planes")

    def score(block: pa.Table, scored: pa.Table) -> pa.Table:
        totals, best = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
        order = np.argsort(scored.column("of_pair").to_numpy())
        pairs, count, top = (scored.column(c).to_numpy()[order] for c in ("of_pair", "count", "best"))
        docs = block.filter(block.column("no").is_valid()).combine_chunks()
        for batch in block.filter(block.column("pair").is_valid()).to_batches():
            if batch.num_rows:
                row, doc, weight = set_bits(batch.column("planes"), batch.column("span")[0].as_py())
                at = np.searchsorted(pairs, batch.column("pair").to_numpy())[row]
                np.add.at(totals, doc, weight * count[at])
                np.add.at(best, doc, weight * top[at])
        no = docs.column("no").to_numpy()
        return pa.table([docs.column("id"), *(docs.column(c) for c in COUNTS), docs.column("groups"), pa.array(best[no]), pa.array(totals[no])],
                        names=[id_col, *COUNTS, "groups", "n_best", "count_sum"])

    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("groups", rows.schema["groups"].dataType), T.StructField("n_best", T.LongType()),
                           T.StructField("count_sum", T.LongType())])
    return rows.groupBy("block").cogroup(returned.groupBy("of")).applyInArrow(score, schema)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def digests(docs: DataFrame, tokenizer_path: str, model_path: str) -> DataFrame:
    """The scores of all documents, with their groups' text as a digest."""
    indexed = index(docs, tokenizer_path, model_path, groups=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256)))
    return document_scores(indexed, pair_scores(indexed)).withColumnRenamed("groups", "groups_sha256")
