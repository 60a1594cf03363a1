"""Operator 13: toxicity by a bidirectional gated recurrent network.

A text's words are read in overlapping windows.  A word's input has two parts:
a vector of the word itself and the mean of vectors of its character 3- and
4-grams, its ends marked; both are looked up by hash.  Two gated recurrent
layers read a window from both sides, attention pools their states (a softmax
over the window's words), and a linear layer gives the window's logit.  A document's
odds are the sum of its windows' odds, so one toxic window marks it; as both
classes are learned from alike, they are scaled by the odds of a toxic label.

Only documents have labels, so the network is trained on documents: the
gradient reaches the windows by their share of the odds.  Training (back
propagation and Adam, in numpy) reads at most ``SAMPLE`` labelled documents
of each class, those of the lowest hashes, takes ``STEPS`` steps whatever
their number, and looks at ``READ`` windows of a document at most in a step.
Vectors of buckets that toxic and other documents touch about as often (a
difference of less than ``APART`` standard errors) stay zero, lest the network
remember documents by their rare words.  Scoring reads every
window of every text, whole; it is spread over the documents and has no
shuffle.  The model is a few numbers per hash bucket, whatever the data.

Cases: words are what lies between ``[\\x20\\x09-\\x0D]``; one of over ``PIECE``
characters counts as several; a null or empty text is one window without
words, whose logit is the bias; a document without an identifier is never
learned from; labels other than 0 and 1 are none; without labels of both
classes every score is the share of toxic labels (0 without any); equal texts get
equal scores; an empty table gives an empty table; of the input only the named
columns are read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import WORD, python_ready
from pageloom.session import new_run_id

#: Bounds of what is learned from: documents of each class, windows of a document.
SAMPLE, READ = 2000, 400
#: Words of a window, and from one window's start to the next's.
WINDOW, STRIDE = 48, 24
#: Hash buckets of words and of character grams, numbers per word and per gram, states per direction, attention.
BUCKETS, GRAMS, WIDTH, STATES, LOOK = 1 << 15, 1 << 15, 12, 16, 16
#: Steps, documents of a step, rate of learning, the bias at first, standard errors of a bucket that is read.
STEPS, DOCS, RATE, START, APART = 300, 24, 0.01, -3.0, 5.0
#: Longest word in characters; words whose inputs a worker remembers.
PIECE, REMEMBER = 24, 150_000
MARKS = ".,;:!?()[]\"'"

_pieces = re.compile(rf"{WORD[:-1]}{{1,{PIECE}}}").findall


def words_of(text: str | None) -> list[str]:
    return _pieces((text or "").lower())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word, gram, of``: each word's bucket, and the buckets of all grams
    with the number of the word that each belongs to."""
    bare = [w.strip(MARKS) for w in words]
    word = np.array([zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in bare], np.int64)
    data = np.frombuffer("".join(f"<{w}>" for w in bare).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(bare)), [len(w) + 2 for w in bare])
    grams, of = [], []
    for n in (3, 4):
        if len(data) < n:
            continue
        mixed = np.full(len(data) - n + 1, n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ data[k:len(data) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
        inside = owner[n - 1:] == owner[:len(owner) - n + 1]
        grams.append((mixed[inside] % np.uint64(GRAMS)).astype(np.int64))
        of.append(owner[:len(owner) - n + 1][inside])
    return word, np.concatenate([*grams, np.empty(0, np.int64)]), np.concatenate([*of, np.empty(0, np.int64)])


def windows_of(sizes: list[int], stride: int = STRIDE, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``document, start`` of all windows: every word lies in one at least,
    the last window ends with the text."""
    docs, starts = [], []
    for d, n in enumerate(sizes):
        at = sorted({0, *range(first, n - WINDOW, stride), max(n - WINDOW, 0)})
        docs += [d] * len(at)
        starts += at
    return np.array(docs, np.int64), np.array(starts, np.int64)


def _summed(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` that have the same number in ``at``."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out[at[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


class Network:
    """``p``: parameters by name.  Directions are 0 (forward) and 1."""

    def __init__(self, p: dict[str, np.ndarray] | None = None):
        if p is None:
            rng = np.random.default_rng(13)

            def some(*shape: int, scale: float) -> np.ndarray:
                return (rng.standard_normal(shape) * scale).astype(np.float32)

            p = {"words": some(BUCKETS, WIDTH, scale=0.1), "grams": some(GRAMS, WIDTH, scale=0.1),
                 "look": some(2 * STATES, LOOK, scale=0.3), "seek": some(LOOK, scale=0.3), "out": some(2 * STATES, scale=0.3),
                 "bias": np.full(1, START, np.float32)}
            for d in (0, 1):
                p |= {f"in{d}": some(2 * WIDTH, 3 * STATES, scale=0.3), f"base{d}": np.zeros(3 * STATES, np.float32),
                      f"state{d}": some(STATES, 3 * STATES, scale=0.25)}
        self.p = p

    def inputs(self, word: np.ndarray, gram: np.ndarray, of: np.ndarray) -> dict:
        """``x`` (a row per word) from :func:`buckets_of`, and what it was made of."""
        count = np.maximum(np.bincount(of, minlength=len(word)), 1).astype(np.float32)[:, None]
        grams = _summed(self.p["grams"][gram], of, len(word)) / count
        return {"word": word, "gram": gram, "of": of, "count": count, "x": np.concatenate([self.p["words"][word], grams], axis=1)}

    def projected(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ self.p[f"in{d}"] + self.p[f"base{d}"] for d in (0, 1)]

    def forward(self, projected: list[np.ndarray], at: np.ndarray, there: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Logits of windows: ``at`` has a row of ``projected`` per window and
        place, ``there`` whether the place has a word.  ``trace`` takes what
        :meth:`backward` needs."""
        n, size = at.shape
        states = np.zeros((n, size, 2 * STATES), np.float32)
        full = bool(there.all())
        for d in (0, 1):
            state, weights = np.zeros((n, STATES), np.float32), self.p[f"state{d}"]
            for t in range(size) if d == 0 else range(size - 1, -1, -1):
                given, carried = projected[d].take(at[:, t], 0), state @ weights
                gates = _sigmoid(given[:, :2 * STATES] + carried[:, :2 * STATES])
                keep, reset = gates[:, :STATES], gates[:, STATES:]
                new = np.tanh(given[:, 2 * STATES:] + reset * carried[:, 2 * STATES:])
                after = new + keep * (state - new)
                if not full:
                    after = np.where(there[:, t, None], after, state)
                if trace is not None:
                    trace.append((d, t, state, gates, new, carried[:, 2 * STATES:]))
                state = states[:, t, d * STATES:(d + 1) * STATES] = after
        seen = np.tanh(states @ self.p["look"])
        wanted = np.where(there, seen @ self.p["seek"], np.float32(-1e9))
        share = np.exp(wanted - wanted.max(axis=1, keepdims=True)) * there
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nts->ns", share, states)
        if trace is not None:
            trace.append((states, seen, share, pooled))
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, made: dict, at: np.ndarray, there: np.ndarray, trace: list, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given each window's ``slope`` (of the loss by its logit)."""
        p, g = self.p, {}
        states, seen, share, pooled = trace.pop()
        g["bias"], g["out"] = slope.sum(keepdims=True), pooled.T @ slope
        to_pooled = slope[:, None] * p["out"]
        to_share = np.einsum("nts,ns->nt", states, to_pooled)
        to_wanted = share * (to_share - (share * to_share).sum(axis=1, keepdims=True))
        g["seek"] = np.einsum("ntl,nt->l", seen, to_wanted)
        to_look = to_wanted[:, :, None] * p["seek"] * (1 - seen ** 2)
        g["look"] = np.einsum("nts,ntl->sl", states, to_look, optimize=True)
        to_states = share[:, :, None] * to_pooled[:, None, :] + to_look @ p["look"].T
        n_words, to_x = len(made["x"]), 0
        later = [np.zeros((len(at), STATES), np.float32) for _ in (0, 1)]
        to_given, to_weights = [[], []], [np.zeros_like(p["state0"]) for _ in (0, 1)]
        for d, t, state, gates, new, carried in reversed(trace):
            keep, reset = gates[:, :STATES], gates[:, STATES:]
            to_after = to_states[:, t, d * STATES:(d + 1) * STATES] + later[d]
            real = there[:, t, None]
            to_new = to_after * (1 - keep) * (1 - new ** 2) * real
            to_gates = np.concatenate([to_after * (state - new), to_new * carried], axis=1) * gates * (1 - gates) * real
            to_carried = np.concatenate([to_gates, to_new * reset], axis=1)
            to_weights[d] += state.T @ to_carried
            later[d] = to_carried @ p[f"state{d}"].T + np.where(real, to_after * keep, to_after)
            to_given[d].append((t, np.concatenate([to_gates, to_new], axis=1)))
        for d in (0, 1):
            g[f"state{d}"] = to_weights[d]
            of = np.concatenate([at[:, t] for t, _ in to_given[d]])
            summed = _summed(np.concatenate([v for _, v in to_given[d]]), of, n_words)
            g[f"in{d}"], g[f"base{d}"] = made["x"].T @ summed, summed.sum(axis=0)
            to_x = to_x + summed @ p[f"in{d}"].T
        g["words"] = _summed(to_x[:, :WIDTH], made["word"], BUCKETS)
        g["grams"] = _summed((to_x[:, WIDTH:] / made["count"])[made["of"]], made["gram"], GRAMS)
        return g


def _matrix(ids: list[np.ndarray], docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``at, there`` of windows over texts whose words have the numbers ``ids``."""
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate([*ids, np.zeros(1, np.int64)])
    place = starts[:, None] + np.arange(WINDOW)
    there = place < sizes[docs][:, None]
    begin = np.r_[0, np.cumsum(sizes)][docs]
    return flat[np.where(there, begin[:, None] + place, len(flat) - 1)], there


def document_logits(logits: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """The log of the sum of the windows' odds per document; every one has a window."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, docs, logits)
    return top + np.log(np.bincount(docs, np.exp(logits - top[docs]), minlength=n))


def train(texts: list[str | None], labels: list[int], steps: int = STEPS) -> Network:
    """A network that tells ``labels`` (0 or 1) of ``texts``, after so many
    steps of ``DOCS`` texts each, half of them of either class."""
    net, rng = Network(), np.random.default_rng(29)
    numbers: dict[str, int] = {}
    ids = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64) for t in texts]
    target = np.array(labels, np.float64)
    word, gram, of = buckets_of(list(numbers) or [""])
    by_word = np.argsort(of, kind="stable")
    gram, gram_sizes = gram[by_word], np.bincount(of, minlength=len(word))
    first_gram = np.cumsum(gram_sizes) - gram_sizes
    touched = {"words": np.zeros((2, BUCKETS)), "grams": np.zeros((2, GRAMS))}
    for y, own in zip(labels, map(np.unique, ids), strict=True):
        touched["words"][y, np.unique(word[own])] += 1
        sizes = gram_sizes[own]
        touched["grams"][y, np.unique(gram[np.repeat(first_gram[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())])] += 1
    each = np.maximum(np.bincount(labels, minlength=2), 1)
    muted = {}
    for name, n in touched.items():
        both = (n.sum(axis=0) + 0.5) / (each.sum() + 1)
        error = np.sqrt(both * (1 - both) * (1 / each).sum())
        muted[name] = np.flatnonzero(np.abs(n[0] / each[0] - n[1] / each[1]) < APART * error)
    for name, rare in muted.items():
        net.p[name][rare] = 0
    mean, square = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in (0, 1))  # of the gradients
    classes = [np.flatnonzero(target == y) for y in (0, 1)]
    waiting = [np.empty(0, np.int64)] * 2
    for step in range(1, steps + 1):
        for y in (0, 1):  # each class is read again and again, in a new order each time
            while len(waiting[y]) < DOCS // 2:
                waiting[y] = np.concatenate([waiting[y], rng.permutation(classes[y])])
        chosen = np.concatenate([w[:DOCS // 2] for w in waiting])
        waiting = [w[DOCS // 2:] for w in waiting]
        docs, starts = windows_of([len(ids[i]) for i in chosen], WINDOW, int(rng.integers(0, WINDOW)))
        if np.bincount(docs).max() > READ:
            few = rng.random(len(docs))
            kept = np.lexsort((few, docs))
            rank = np.arange(len(docs)) - np.searchsorted(docs[kept], docs[kept])
            kept = np.sort(kept[rank < READ])
            docs, starts = docs[kept], starts[kept]
        at, there = _matrix([ids[i] for i in chosen], docs, starts)
        used, at = np.unique(at, return_inverse=True)
        at = at.reshape(there.shape)
        sizes = gram_sizes[used]
        place = np.repeat(first_gram[used] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        made = net.inputs(word[used], gram[place], np.repeat(np.arange(len(used)), sizes))
        trace: list = []
        logits = net.forward(net.projected(made["x"]), at, there, trace).astype(np.float64)
        own = document_logits(logits, docs, len(chosen))
        to_doc = (_sigmoid(own) - target[chosen]) / len(chosen)
        slope = (to_doc[docs] * np.exp(logits - own[docs])).astype(np.float32)
        rate = RATE * (1 - step / steps / 2) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for name, grad in net.backward(made, at, there, trace, slope).items():
            if name in muted:
                grad[muted[name]] = 0
            mean[name] += 0.1 * (grad - mean[name])
            square[name] += 0.001 * (grad ** 2 - square[name])
            net.p[name] -= (rate * mean[name] / (np.sqrt(square[name]) + 1e-7)).astype(np.float32)
    return net


class Scorer:
    """Window logits of texts; the inputs of words are remembered, within bounds."""

    def __init__(self, net: Network):
        self.net = net
        self.numbers: dict[str, int] = {}
        self.tables = [np.zeros((1024, 3 * STATES), np.float32) for _ in (0, 1)]

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``document, start, logit`` of every window."""
        words = [words_of(t) for t in texts]
        if len(self.numbers) > REMEMBER:
            self.numbers.clear()
        numbers, known = self.numbers, len(self.numbers)
        new = sorted(set().union(*words).difference(numbers))
        numbers.update(zip(new, range(known, known + len(new)), strict=True))
        ids = [np.array(list(map(numbers.__getitem__, some)), np.int64) for some in words]
        if new:
            for k in range(0, len(new), 20000):
                rows = self.net.projected(self.net.inputs(*buckets_of(new[k:k + 20000]))["x"])
                for d in (0, 1):
                    while len(self.tables[d]) < known + k + len(rows[d]):
                        self.tables[d] = np.concatenate([self.tables[d], np.zeros_like(self.tables[d])])
                    self.tables[d][known + k:known + k + len(rows[d])] = rows[d]
        docs, starts = windows_of([len(x) for x in ids])
        logits = np.empty(len(docs))
        sizes = np.array([len(x) for x in ids], np.int64)[docs]
        for some in (np.flatnonzero(sizes >= WINDOW), np.flatnonzero(sizes < WINDOW)):
            for k in range(0, len(some), 1024):
                part = some[k:k + 1024]
                at, there = _matrix(ids, docs[part], starts[part])
                most = max(int(there.sum(axis=1).max()), 1)
                logits[part] = self.net.forward(self.tables, at[:, :most], there[:, :most])
        return docs, starts, logits


def _bucket(id_col: str) -> Column:
    """CRC-32 of the identifier's text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def held_out(id_col: str, folds: int) -> Column:
    """Whether a document's label is never learned from."""
    return F.col(id_col).isNull() | (_bucket(id_col) % folds == 0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        folds: int = 5) -> tuple[Network | None, float]:
    """The network and the share of toxic labels, from the documents that are
    not :func:`held_out`; at most ``SAMPLE`` of each class come to the driver."""
    usable = labels.where(~held_out(id_col, folds)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    shares = {r["__y"]: r["count"] for r in usable.where(F.col("__y").isin(0, 1)).groupBy("__y").count().collect()}
    share = shares.get(1, 0) / max(sum(shares.values()), 1)
    if len(shares) < 2:
        return None, share
    chosen = [usable.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE) for y in (0, 1)]
    one = docs.select(F.col(id_col), F.col(text_col).alias("__t")).join(
        F.broadcast(chosen[0].unionByName(chosen[1])), F.col(id_col) == F.col("__id"))  # 2 x SAMPLE rows at most
    rows = sorted(map(tuple, one.groupBy("__id", "__y").agg(F.min(F.coalesce("__t", F.lit("")))).collect()))
    return train([r[2] for r in rows], [r[1] for r in rows]), share


_SCORERS: dict[str, Scorer] = {}


def score(docs: DataFrame, model: tuple[Network | None, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1) and ``windows`` (``start, score`` of each,
    in words) of every document."""
    spark, rows = python_ready(docs), docs.select(id_col, text_col)
    net, share = model
    prior = np.log(share / (1 - share)) if net else 0.0
    shared = spark.sparkContext.broadcast(net.p if net else None)  # a few numbers per hash bucket
    key, window = new_run_id(), pa.struct([("start", pa.int64()), ("score", pa.float64())])

    def run(batches):
        if shared.value is not None and key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(Network(shared.value))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                texts = some.column(1).to_pylist()
                if shared.value is None:
                    found, starts = np.arange(len(texts)), np.zeros(len(texts), np.int64)
                    each = whole = np.full(len(texts), share)
                else:
                    found, starts, logits = _SCORERS[key].score(texts)
                    each, whole = _sigmoid(logits), _sigmoid(document_logits(logits, found, len(texts)) + prior)
                spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(np.round(each, 6))], fields=list(window))
                cuts = np.searchsorted(found, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.round(whole, 6)), pa.ListArray.from_arrays(cuts, spans)],
                                                 [id_col, "score", "windows"])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("score", T.DoubleType())]))
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("score", T.DoubleType()), T.StructField("windows", spans)]))


def verdicts(scored: DataFrame, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """``id_col, held_out, score, predicted`` of :func:`score`'s rows."""
    return scored.select(id_col, held_out(id_col, folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
