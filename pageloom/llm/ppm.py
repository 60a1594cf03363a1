"""Operator 4: language-model scoring by prediction by partial matching.

The model reads a text as lower-case words, each ended by a space, and an end
mark, and predicts it byte by byte.  Its trie holds, for every context of up
to ``ORDER`` bytes, how often each byte followed it in the training words.  A
byte is predicted by the longest context seen in training; one that it has
not seen there costs an escape and is looked for in the context one byte
shorter, where the bytes of the longer one are excluded.  Below the empty
context all symbols not seen at all are equally likely.

How likely an escape is, is estimated from the training counts: taking one
occurrence away from a context leaves it with n occurrences of d bytes, and
that occurrence would have been an escape if it was its byte's only one.
Over all contexts of an order with like n and d this gives the rate
(``ESCAPES`` says how they are grouped).

With ``across`` contexts run on over the words' ends: they hold the last bytes
of the text so far, and at its start a space and before it one byte for the
text's class, a column such as its language.  Without it they stop at a word's
start, as if every word were its text's first, so that a word's probability
depends on class and word alone.  The class itself is charged to the text.

A byte's key is its context and itself.  The keys are ordered by the context
read backwards from its last byte, then by the byte, so that the grams of a
context of any order lie together, and they are dealt out to buckets by the
last ``DEALT`` bytes of the context: a bucket holds all there is to know of
the contexts that are at least as long.  Shorter contexts are summed over the
buckets.  Only these and the escape rates, both of bounded number (at most
SYMBOLS ** DEALT and 8 x 21 x 31 rows, whatever the corpus), are collected and
sent to the tasks.

Texts meet the model by chunks: a chunk sends every bucket its different keys,
packed, with how often its training texts hold them.  A bucket adds up the
chunks' counts, and answers each chunk with what tells the key's probability:
its count and its context's numbers, or for a key that training texts do not
hold the probability itself.  The chunk makes the keys of its texts again and
adds the answers up per text.  The counts of whole words travel alike, dealt
out by the words' crc32.

Cases: a null text is the empty text, whose only token is its end; a null
identifier counts as the empty text in the choice of training rows; a null
class is a class of its own; repeated rows are scored (and learned from) as
often as they are there; without training rows all symbols are equally
likely; an empty table gives an empty table.  Only the id, text and class
columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import python_ready, settings, written
from pageloom.session import materialize_bucketed

#: Bytes of context; with the predicted byte they fill a key's 64 bits.
ORDER = 7
#: A word's end, a text's end (no word holds either), and the
#: number of symbols: all bytes but tab, VT, FF and CR.
WORD_END, TEXT_END, SYMBOLS = 0x20, 0x0A, 252
#: Escape rates are grouped by order, binary digits of n and d, up to these.
ESCAPES = (20, 30)
#: A chunk is closed at this many bytes or rows; keys are made for so many bytes at once.
CHUNK_BYTES, CHUNK_ROWS, BLOCK_BYTES = 12 << 20, 60_000, 2 << 20
#: Keys are dealt out by so many last bytes of the context, to so many buckets (a
#: power of 2); words to the buckets after those.
DEALT, BUCKETS, WORD_BUCKETS = 3, 1024, 256
#: An odd factor mixes the bytes that keys are dealt out by; another undoes it.
_REST = 64 - 8 * DEALT
_MIX = 0x9E3779
_UNMIX = pow(_MIX, -1, 1 << 8 * DEALT)
#: So many keys are merged at once.
MERGED = 1 << 22


def _segments(words: list[bytes], kind: int, across: bool) -> list[bytes]:
    """What is spelled, each after the ``ORDER`` bytes before it: the whole
    text, or its words one by one."""
    end, text_end = bytes([WORD_END]), bytes([TEXT_END])
    before = end * (ORDER - 2) + bytes([kind]) + end
    if across:
        return [before + end.join([*words, text_end])]
    return [*[before + w + end for w in words], before + text_end]


def _keys(segments: list[bytes]) -> np.ndarray:
    """Key of every byte of the segments behind the first ``ORDER``."""
    flat = b"".join(segments)
    lengths = np.array([len(x) - ORDER for x in segments], np.int64)
    # eight bytes from every place on, the last one highest
    eight = np.ndarray((len(flat) - ORDER,), "<u8", flat, strides=(1,))
    own = np.ones(len(eight) + ORDER, bool)
    ends = np.cumsum(lengths + ORDER)
    for j in range(1, ORDER + 1):
        own[ends - j] = False
    keys = eight[own[:len(eight)]]
    return _mixed((keys << np.uint64(8)) | (keys >> np.uint64(56)), _MIX)


def _mixed(keys: np.ndarray, factor: int) -> np.ndarray:
    """The bytes that keys are dealt out by, multiplied: one to one."""
    return (((keys >> np.uint64(_REST)) * np.uint64(factor)) << np.uint64(_REST)) | (keys & np.uint64((1 << _REST) - 1))


def _cut(keys: np.ndarray, k: int) -> np.ndarray:
    """Keys of the grams with k bytes of context: the others are 0."""
    return keys & np.uint64(((1 << 8 * k) - 1) << (64 - 8 * k) | 0xFF)


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Places where another value begins."""
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)


def _merged(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of sorted parts, in order, and the sums of their counts."""
    held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))], 0

    def merge():
        keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        starts = _starts(keys)
        return keys[starts], _sums(counts[order], starts)

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > max(MERGED, 2 * len(held[0][0])):
            held, size = [merge()], 0
    return merge()


def _packed(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones ..., compressed; the first
    byte tells how many bytes of a value are not all 0."""
    whole = np.ascontiguousarray(values).view(np.uint64)
    used = max(1, -(-int(whole.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 8)[:, :used].T)
    return bytes([used]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    used = data[0]
    planes = np.frombuffer(pa.decompress(memoryview(data)[1:], n * used, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :used] = planes.reshape(used, n).T
    return out.view(kind).reshape(n)


def _as_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _class(class_col: str | None) -> Column:
    kind = F.coalesce(F.col(class_col).cast("string"), F.lit("")) if class_col else F.lit("")
    return (F.crc32(kind.cast("binary")) % 256).cast("int")


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of every token of the texts (words, each with the space that
    ends it, then the text's end), how many each text has, and the words by number."""
    end, text_end = bytes([WORD_END]), bytes([TEXT_END])
    flat = b"".join([x + end + text_end + end if x else text_end + end for x in texts])
    ends = np.append(0, np.flatnonzero(np.frombuffer(flat, np.uint8) == WORD_END) + 1)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat)]).dictionary_encode()
    lengths = np.array([x.count(end) + 2 if x else 1 for x in texts], np.int64)
    return tokens.indices.to_numpy(), lengths, tokens.dictionary


def _dealt(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers in the order of their buckets, and where each bucket ends."""
    buckets = np.array([zlib.crc32(w) % WORD_BUCKETS for w in words.to_pylist()], np.int64)
    return np.argsort(buckets, kind="stable"), np.cumsum(np.bincount(buckets, minlength=WORD_BUCKETS))


def _blocks(texts: list[bytes], kinds: list[int], across: bool) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Keys of so many texts at once, and how many each has; ``texts`` are words with single spaces."""
    segments, lengths, size = [], [], 0
    for i, (text, kind) in enumerate(zip(texts, kinds, strict=True)):
        own = _segments(text.split(), kind, False) if not across else _segments([text] if text else [], kind, True)
        lengths.append(sum(map(len, own)) - ORDER * len(own))
        segments += own
        size += lengths[-1]
        if size >= BLOCK_BYTES or i == len(texts) - 1:
            yield _keys(segments), lengths
            segments, lengths, size = [], [], 0


def chunked(docs: DataFrame, id_col: str, text_col: str, class_col: str | None, train: Column) -> DataFrame:
    """The texts as rows ``chunk, data``, in lower case with single spaces.  A
    chunk is numbered by its partition and place there, which a task that
    runs again repeats.  They are written as the last step groups them."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                       train.alias("train"), _class(class_col).alias("kind"))

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        texts, parts, size = [], [], 0

        def close():
            about = pa.Table.from_batches(parts).combine_chunks().append_column("text", pa.array(texts, pa.large_binary()))
            return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([_as_bytes(about.to_batches()[0])])], ["chunk", "data"])

        for batch in batches:
            first = 0
            for k, text in enumerate(batch.column(1)):
                texts.append(bytes([WORD_END]).join((text.as_py() or b"").lower().split()))
                size += len(texts[-1])
                if size >= CHUNK_BYTES or len(texts) >= CHUNK_ROWS or k == batch.num_rows - 1:
                    parts.append(batch.select(["id", "train", "kind"]).slice(first, k + 1 - first))
                    first = k + 1
                if size >= CHUNK_BYTES or len(texts) >= CHUNK_ROWS:
                    yield close()
                    texts, parts, size = [], [], 0
                    chunk += 1
        if texts:
            yield close()

    return _bucketed(rows.mapInArrow(run, "chunk bigint, data binary"), "chunk", "lm_texts")


def _bucketed(rows: DataFrame, key: str, tag: str) -> DataFrame:
    """``written``, in buckets by ``key``: grouping by it needs no exchange."""
    with settings(rows.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return materialize_bucketed(rows, [key], tag)


def index_texts(texts: DataFrame, across: bool = False) -> DataFrame:
    """Chunks of texts as rows ``chunk, bucket, n, data, seen``: the chunk's
    n different keys or words of a bucket, and how often training texts hold each."""
    def counted(texts, kinds, flags):
        for train in (True, False):
            at = [i for i, f in enumerate(flags) if f == train]
            for keys, _ in _blocks([texts[i] for i in at], [kinds[i] for i in at], across):
                keys.sort()
                starts = _starts(keys)
                yield keys[starts], (np.diff(np.append(starts, len(keys))) * int(train)).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = _from_bytes(data.as_py())
                texts, kinds, held = (part.column(x).to_pylist() for x in ("text", "kind", "train"))
                out = []
                keys, counts = _merged(counted(texts, kinds, held))
                cuts = np.searchsorted(keys, np.arange(1, BUCKETS, dtype=np.uint64) << np.uint64(65 - BUCKETS.bit_length()))
                for b, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts), strict=True)):
                    if len(k):
                        out.append((b, len(k), _packed(k), _packed(c)))
                tokens, lengths, words = _tokens(texts)
                times = np.bincount(tokens[np.repeat(np.array(held, bool), lengths)], minlength=len(words))
                order, ends = _dealt(words)
                for b, at in enumerate(np.split(order, ends[:-1])):
                    if len(at):
                        named = pa.RecordBatch.from_arrays([words.take(pa.array(at))], ["word"])
                        out.append((BUCKETS + b, len(at), _as_bytes(named), _packed(times[at])))
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(out)), *map(pa.array, zip(*out, strict=True))],
                                                 ["chunk", "bucket", "n", "data", "seen"])

    return _bucketed(texts.mapInArrow(run, "chunk bigint, bucket bigint, n bigint, data binary, seen binary"), "bucket", "lm_index")


class _Level:
    """Grams of an order: ``g`` (sorted) and ``c`` (times); of their contexts
    ``x`` (sorted) ``n``, ``d`` (times and different bytes) and ``once``
    (bytes that occur once); ``at``: each gram's context.  ``below`` sets
    ``pn``, ``pd``: the same of the context one byte shorter without the bytes
    seen in this one."""
    def __init__(self, g: np.ndarray, c: np.ndarray):
        self.g, self.c = g, c
        self.starts = _starts(g >> np.uint64(8))
        self.x = (g >> np.uint64(8))[self.starts]
        self.n, self.once = _sums(c, self.starts), _sums((c == 1).astype(np.int64), self.starts)
        self.d = np.diff(np.append(self.starts, len(g)))
        self.at = np.repeat(np.arange(len(self.x)), self.d)

    def shorter(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The grams with k bytes of context, and their times."""
        g = _cut(self.g, k)
        order = np.argsort(g, kind="stable")
        starts = _starts(g[order])
        return g[order][starts], _sums(self.c[order], starts)

    def below(self, level: _Level | None, g: np.ndarray) -> None:
        """``g``: the grams as ``level`` has them (None: all symbols, not counted)."""
        if level is None:
            self.pn, self.pd = np.zeros(len(self.x), np.int64), SYMBOLS - self.d
            return
        at = np.searchsorted(level.g, g)
        first = level.at[at[self.starts]]
        self.pn, self.pd = level.n[first] - _sums(level.c[at], self.starts), level.d[first] - self.d

    def left_out(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Per group how often an occurrence left out of its context was an escape, and how many were left out."""
        many = self.n > 1
        n, d, once = self.n[many], self.d[many], self.once[many]
        alone, other = _group(k, n - 1, d - 1), _group(k, n - 1, d)
        groups = (ORDER + 1) * (ESCAPES[0] + 1) * (ESCAPES[1] + 1)
        taken = np.bincount(alone, once, groups)
        return taken.astype(np.int64), (taken + np.bincount(other, n - once, groups)).astype(np.int64)


def _group(k: int, n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Number of the group of contexts whose escape rate is shared."""
    digits = np.minimum(np.frexp(n.astype(np.float64))[1], ESCAPES[0])
    return (k * (ESCAPES[0] + 1) + digits) * (ESCAPES[1] + 1) + np.minimum(d, ESCAPES[1])


def _counted(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's keys and how often training texts hold them."""
    return _merged((_unpacked(data, n, np.uint64), _unpacked(seen, n, np.int64)) for n, data, seen in
                   zip(*(rows.column(x).to_pylist() for x in ("n", "data", "seen")), strict=True))


def _long_levels(keys: np.ndarray, counts: np.ndarray) -> dict[int, _Level]:
    """A bucket's levels from ``ORDER`` down to ``DEALT``."""
    levels = {ORDER: _Level(keys[counts > 0], counts[counts > 0])}
    for k in range(ORDER - 1, DEALT - 1, -1):
        levels[k] = _Level(*levels[k + 1].shorter(k))
        levels[k + 1].below(levels[k], _cut(levels[k + 1].g, k))
    return levels


def train_trie(grams: DataFrame) -> tuple[list[_Level], np.ndarray, np.ndarray]:
    """The levels below ``DEALT`` and, per group of contexts of all levels,
    how often an occurrence left out was an escape, and of how many."""
    def run(rows: pa.Table) -> pa.Table:
        levels = _long_levels(*_counted(rows))
        taken, of = (sum(x) for x in zip(*(level.left_out(k) for k, level in levels.items()), strict=True))
        used = np.flatnonzero(of)
        # the bucket's grams with one byte of context less; those of several buckets add up
        whole = _Level(_mixed(levels[DEALT].g, _UNMIX), levels[DEALT].c)
        g, c = whole.shorter(DEALT - 1)
        return pa.table({"gram": np.repeat([False, True], [len(used), len(g)]), "of_what": np.append(used, g.view(np.int64)),
                         "a": np.append(taken[used], c), "b": np.append(of[used], np.zeros(len(g), np.int64))})

    parts = grams.groupBy("bucket").applyInArrow(run, "gram boolean, of_what bigint, a bigint, b bigint")
    sums = written(parts.groupBy("gram", "of_what").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "lm-low").toArrow()
    low = sums.filter(sums.column("gram"))
    g, c = low.column("of_what").to_numpy().view(np.uint64), low.column("a").to_numpy()
    order = np.argsort(g)
    levels = [_Level(g[order], c[order])]
    for k in range(DEALT - 2, -1, -1):
        levels.insert(0, _Level(*levels[0].shorter(k)))
        levels[1].below(levels[0], _cut(levels[1].g, k))
    levels[0].below(None, levels[0].g)
    taken, of = (sum(x) for x in zip(*(level.left_out(k) for k, level in enumerate(levels)), strict=True))
    rates = sums.filter(pc.invert(sums.column("gram")))
    at = rates.column("of_what").to_numpy()
    taken[at] += rates.column("a").to_numpy()
    of[at] += rates.column("b").to_numpy()
    return levels, taken, of


def _find(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted array, and whether they are there."""
    if not len(sorted_):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def _escape(taken: np.ndarray, of: np.ndarray, k: int, n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The escape rate of contexts of order ``k`` with ``n`` and ``d``."""
    grp = _group(k, n, d)
    return (taken[grp] + d / np.maximum(n + d, 1)) / (of[grp] + 2)


def gram_scores(keys: np.ndarray, counts: np.ndarray, low: list[_Level], taken: np.ndarray, of: np.ndarray) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """For a bucket's keys: ``n`` and ``d`` of their contexts, and for those
    not seen in training the log10 probability of the byte after its context."""
    levels = _long_levels(keys, counts)
    short = _mixed(levels[DEALT].g, _UNMIX)
    levels[DEALT].below(low[-1], _cut(short, DEALT - 1))
    levels |= dict(enumerate(low))
    top = levels[ORDER]
    all_n, all_d, out = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys))
    all_n[counts > 0], all_d[counts > 0] = top.n[top.at], top.d[top.at]
    # bytes not seen after their context: en, ed are the shorter context's numbers without the longer one's bytes
    rest = np.flatnonzero(counts == 0)
    asked, acc = keys[rest], np.zeros(len(rest))
    en, ed, met = np.zeros(len(rest), np.int64), np.full(len(rest), SYMBOLS), np.zeros(len(rest), bool)
    for k in range(ORDER, -1, -1):
        level = levels[k]
        if k == DEALT - 1:
            asked = _mixed(asked, _UNMIX)
        if not len(level.g) or not len(rest):
            continue
        g = _cut(asked, k)
        ctx, there = _find(level.x, g >> np.uint64(8))
        gram, hit = _find(level.g, g)
        n, d = np.where(met, en, level.n[ctx]), np.where(met, ed, level.d[ctx])
        e = _escape(taken, of, k, n, d)
        out[rest[hit]] = (acc + np.log10((1 - e) * level.c[gram] / np.maximum(n, 1)))[hit]
        acc = np.where(there & (d > 0), acc + np.log10(np.where(there & (d > 0), e, 1)), acc)
        en, ed, met = np.where(there, level.pn[ctx], en), np.where(there, level.pd[ctx], ed), met | there
        rest, asked, acc, en, ed, met = (x[~hit] for x in (rest, asked, acc, en, ed, met))
    out[rest] = acc - np.log10(ed)
    return all_n, all_d, out


def answers(grams: DataFrame, low: list[_Level], taken: np.ndarray, of: np.ndarray) -> DataFrame:
    """``chunk, bucket, n, data, rest``: the chunk's keys' times with those of
    their contexts' other bytes and the contexts' ``d``, and log10
    probabilities of the keys that training texts do not hold."""
    def run(rows: pa.Table) -> pa.Table:
        keys, counts = _counted(rows)
        of_n, of_d, logp = gram_scores(keys, counts, low, taken, of)
        data, rest = [], []
        for n, asked in zip(rows.column("n").to_pylist(), rows.column("data").to_pylist(), strict=True):
            at = np.searchsorted(keys, _unpacked(asked, n, np.uint64))
            data.append(_packed(np.concatenate([counts[at], of_n[at] - counts[at], of_d[at]])))
            rest.append(_packed(logp[at[counts[at] == 0]]))
        return rows.select(["chunk", "bucket", "n"]).append_column("data", pa.array(data, pa.binary())).append_column(
            "rest", pa.array(rest, pa.binary()))

    return grams.groupBy("bucket").applyInArrow(run, "chunk bigint, bucket bigint, n bigint, data binary, rest binary")


def _answered(n: int, data: bytes, rest: bytes, taken: np.ndarray, of: np.ndarray) -> np.ndarray:
    """log10 probabilities of a chunk's n keys of a bucket."""
    c, others, d = _unpacked(data, 3 * n, np.int64).reshape(3, n)
    held, logp = c > 0, np.empty(n)
    c, all_ = c[held], (c + others)[held]
    logp[held] = np.log10((1 - _escape(taken, of, ORDER, all_, d[held])) * c / all_)
    logp[~held] = _unpacked(rest, n - len(c), np.float64)
    return logp


def word_counts(words: DataFrame) -> DataFrame:
    """``chunk, bucket, n, data, total, known``: how often training texts hold
    the chunk's words; a row without a chunk tells the bucket's sum and number
    of words that they hold."""
    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n").to_pylist()
        names = pa.concat_arrays([_from_bytes(x).column(0) for x in rows.column("data").to_pylist()]).dictionary_encode().indices.to_numpy()
        c = np.zeros(names.max() + 1, np.int64)
        np.add.at(c, names, np.concatenate([_unpacked(x, n, np.int64) for n, x in zip(sizes, rows.column("seen").to_pylist(), strict=True)]))
        data = [_packed(c[x]) for x in np.split(names, np.cumsum(sizes)[:-1])]
        found = rows.select(["chunk", "bucket", "n"]).append_column("data", pa.array(data, pa.binary()))
        none = pa.nulls(len(found), pa.int64())
        sums = pa.table([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.int64()),
                         pa.array([None], pa.binary()), pa.array([c.sum()]), pa.array([(c > 0).sum()])],
                        ["chunk", "bucket", "n", "data", "total", "known"])
        return pa.concat_tables([found.append_column("total", none).append_column("known", none), sums])

    return written(words.groupBy("bucket").applyInArrow(
        run, "chunk bigint, bucket bigint, n bigint, data binary, total bigint, known bigint"), "lm-words")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = None,
          across: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.  Rows whose crc32 of the identifier's
    text is no multiple of 10 are learned from.  ``across``: contexts run on
    over the words' ends."""
    python_ready(docs)
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    texts = chunked(docs, id_col, text_col, class_col, crc % 10 != 0)
    indexed = index_texts(texts, across)
    grams = indexed.where(F.col("bucket") < BUCKETS)
    words = word_counts(indexed.where(F.col("bucket") >= BUCKETS))
    n, v = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    low, taken, of = train_trie(grams)
    found = words.where("chunk is not null").select("chunk", "bucket", "n", "data", F.lit(None).cast("binary").alias("rest"))
    answered = answers(grams, low, taken, of).unionByName(found)
    # a class costs its share of the training texts (one of 256, half an observation each)
    ends = docs.where(crc % 10 != 0).groupBy(_class(class_col).alias("kind")).count().collect()  # 256 at most
    share = np.full(256, 0.5)
    for row in ends:
        share[row["kind"]] += row["count"]
    kind_cost = np.log10(share / share.sum()) if class_col else np.zeros(256)
    id_type = docs.select(id_col).schema[0].dataType

    def add(texts: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("bucket")
        bucket, sizes, data, rest = (rows.column(x).to_pylist() for x in ("bucket", "n", "data", "rest"))
        part = _from_bytes(texts.column("data")[0].as_py())
        texts, kinds = part.column("text").to_pylist(), part.column("kind").to_pylist()
        split = sum(b < BUCKETS for b in bucket)
        logp = np.concatenate([_answered(*x, taken, of) for x in zip(sizes[:split], data[:split], rest[:split], strict=True)])
        found = np.concatenate([_unpacked(x, k, np.int64) for x, k in zip(data[split:], sizes[split:], strict=True)])
        # the keys of the texts again: a block's different ones, and for each byte which it is
        blocks = []
        for keys, lengths in _blocks(texts, kinds, across):
            order = np.argsort(keys)
            keys = keys[order]
            starts = _starts(keys)
            which = np.empty(len(keys), np.uint32)
            which[order] = np.repeat(np.arange(len(starts), dtype=np.uint32), np.diff(np.append(starts, len(keys))))
            blocks.append((keys[starts], which, lengths))
        every = np.concatenate([keys for keys, _, _ in blocks])
        every.sort()
        every = every[_starts(every)]
        scores = [np.add.reduceat(logp[np.searchsorted(every, keys)][which], np.cumsum([0, *lengths[:-1]]))
                  for keys, which, lengths in blocks]
        tokens, lengths, words = _tokens(texts)
        c = np.empty(len(found), np.int64)
        c[_dealt(words)[0]] = found
        base, starts = np.log10((c + 0.1) / (n + 0.1 * (v + 1))), np.cumsum(lengths) - lengths
        return pa.table({
            id_col: part.column("id"), "held_out": pc.invert(part.column("train")),
            "n_tokens": lengths, "n_known": np.add.reduceat((c > 0).astype(np.int64)[tokens], starts),
            "train_tokens": np.full(len(texts), n, np.int64), "base_score": np.add.reduceat(base[tokens], starts),
            "score": np.concatenate(scores) + kind_cost[np.array(kinds)]})

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("held_out", T.BooleanType()),
                           *[T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")],
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return texts.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(add, schema)
