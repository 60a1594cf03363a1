"""Operator 11: periodic run detection by Baier's grouping.

A run is a stretch of consecutive words that repeats with a smallest period
and cannot be made longer with it.  Every run holds, under the order of the
words or under its reverse, a Lyndon word of the period's length that is the
longest one from its place (the runs theorem), so the runs are found from
the two Lyndon arrays:

1. Phase one of Baier's suffix sorter groups the suffixes by first word and
   takes the groups from the greatest down.  Each suffix of a group points to
   the nearest earlier one of a lower group; the suffixes pointed at move, by
   the number of pointers, into new groups just above their own, whose prefix
   grows by that of the group as often as they were pointed at.  When its
   turn comes, a group's prefix is the longest Lyndon word of its suffixes.
2. Every Lyndon word is extended to both sides through longest common
   extensions: prefix sums of hashes, searched by halving for all at once.
   What comes out is compared word by word, so a hash never decides a result.

Before that, words that cannot be in a run are set aside: in a run of
exponent ``e`` every word occurs at least ``floor(e)`` times, so a word that
is rarer within its stretch only parts two stretches.  This is repeated until
no such word is left and loses no run; ``exponent=2`` gives all runs of the
theorem.

Documents are worked on one by one where Spark has them; there is no shuffle.

Cases: words are what lies between ``[\\x20\\x09-\\x0D]``; a null or empty text
has no word, no run and an empty ``collapsed``; a null identifier is handed
through; equal rows come out equal; an empty table gives an empty table; only
the two named columns are read, so others never clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import WORD, python_ready

_words = re.compile(WORD).findall

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word from every place of a sequence of
    non-negative ranks (Baier's phase one)."""
    n = len(ranks)
    by_rank: dict[int, list[int]] = {}
    for i, r in enumerate(ranks):
        by_rank.setdefault(r, []).append(i)
    members, size, prefix, below, above = [], [], [], [], []
    group = [0] * n
    for g, r in enumerate(sorted(by_rank)):
        places = by_rank[r]
        members.append(places)
        size.append(len(places))
        prefix.append(1)
        below.append(g - 1)
        above.append(g + 1)
        for i in places:
            group[i] = g
    # place -> nearest place to the left whose group has not had its turn, itself included (shifted by one, 0: none)
    left = list(range(n + 1))
    lengths = [0] * n
    g = len(members) - 1
    while g >= 0:
        now = members[g] if len(members[g]) == size[g] else [i for i in members[g] if group[i] == g]
        grown = prefix[g]
        for i in now:
            lengths[i] = grown
            left[i + 1] = i
        pointers: dict[int, int] = {}
        for i in now:
            p = i
            while left[p] != p:
                left[p] = left[left[p]]
                p = left[p]
            if p:
                pointers[p - 1] = pointers.get(p - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, count in pointers.items():
            moved.setdefault((-count, group[p]), []).append(p)
        for (count, old), places in sorted(moved.items()) if len(moved) > 1 else moved.items():
            if size[old] == len(places):  # the whole group: it stays where it is
                prefix[old] -= count * grown
                continue
            size[old] -= len(places)
            new = len(members)
            for p in places:
                group[p] = new
            members.append(places)
            size.append(len(places))
            prefix.append(prefix[old] - count * grown)
            below.append(old)
            above.append(above[old])
            if above[old] < len(below):
                below[above[old]] = new
            above[old] = new
        g = below[g]
    return lengths


class _Extensions:
    """Longest common extensions of pairs of places ``i < j`` of a sequence."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n, 0x5851F42D4C957F2D, np.uint64)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum((mixed ^ (mixed >> np.uint64(32))) * self.powers[:n], dtype=np.uint64)]
        self.n = n

    def _same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[i + size] - self.sums[i]) * self.powers[j - i] == self.sums[j + size] - self.sums[j]

    def _longest(self, most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            half = (low + high + 1) >> 1
            fits = same(half)
            low = np.where(open_ & fits, half, low)
            high = np.where(open_ & ~fits, half - 1, high)
        return low

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``j`` on are the same."""
        return self._longest(self.n - j, lambda size: self._same(i, j, size))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and ``j`` are the same."""
        return self._longest(i.copy(), lambda size: self._same(i - size, j - size, size))


def _exact(words: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether a stretch has the period and can't be made longer with it."""
    same = words[start:end - period] == words[start + period:end]
    return bool(same.all()) and (start == 0 or words[start - 1] != words[start + period - 1]) and (
        end == len(words) or words[end] != words[end - period])


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """``start, end`` of the run around the Lyndon word at ``at``, without hashes."""
    same = words[:-period] == words[period:]
    differs = np.flatnonzero(~same)
    after = differs[np.searchsorted(differs, at)] if len(differs) and differs[-1] >= at else len(same)
    earlier = np.searchsorted(differs, at) - 1
    return (int(differs[earlier]) + 1 if earlier >= 0 else 0), int(after) + period


def _extend(words: np.ndarray, lengths: np.ndarray, exponent: int, length: int, found: set) -> None:
    """Add to ``found`` the runs (``start, length, period``) of the Lyndon words."""
    n = len(words)
    at = np.flatnonzero(np.arange(n) + lengths < n)
    period = lengths[at]
    # a root that the word after it or the word before it doesn't repeat has no second one beside it
    goes_on = words[at] == words[at + period]
    came = (at > 0) & (words[at - 1] == words[at + period - 1])
    at, period = at[goes_on | came], period[goes_on | came]
    if not len(at):
        return
    extensions = _Extensions(words)
    start, end = at - extensions.before(at, at + period), at + period + extensions.after(at, at + period)
    long = (end - start >= exponent * period) & (end - start >= length)
    seen = set()
    for s, e, p, i in zip(start[long].tolist(), end[long].tolist(), period[long].tolist(), at[long].tolist(), strict=True):
        if (s, e, p) not in seen:
            seen.add((s, e, p))
            if not _exact(words, s, e, p):  # hashes of different words met
                s, e = _extended(words, i, p)
            if e - s >= max(exponent * p, length):
                found.add((s, e - s, p))


def _stretches(words: np.ndarray, exponent: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``places, words`` of the words that may be in a run of ``exponent``;
    one word that occurs once parts two stretches."""
    places, part = np.arange(len(words)), np.zeros(len(words), np.int64)
    while len(places):
        _, key, count = np.unique(part * (int(words.max()) + 1) + words[places], return_inverse=True, return_counts=True)
        kept = count[key] >= exponent
        starts = np.flatnonzero(np.r_[True, (np.diff(places) > 1) | (np.diff(part) != 0) | (kept[1:] != kept[:-1])])
        sizes = np.diff(np.r_[starts, len(places)])
        stretch = np.repeat(np.arange(len(starts)), sizes)
        kept &= sizes[stretch] >= length
        if kept.all():
            break
        places, part = places[kept], stretch[kept]
    if not len(places):
        return places, words[:0]
    cuts = np.flatnonzero(np.diff(part)) + 1
    own = int(words.max()) + 1 + np.arange(len(cuts))
    return np.insert(places, cuts, -1), np.insert(words[places], cuts, own)


def find_runs(words: np.ndarray, exponent: int = 4, length: int = 6) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``exponent`` periods
    (an integer from 2) and ``length`` words, by start and then period."""
    if len(words) < max(length, exponent):
        return []
    places, words = _stretches(words, exponent, length)
    if not len(words):
        return []
    found: set[tuple[int, int, int]] = set()
    top = int(words.max())
    for ranks in (words, top - words):
        _extend(words, np.array(lyndon_lengths(ranks.tolist())), exponent, length, found)
    return sorted((int(places[s]), size, p) for s, size, p in found)


def runs_of_words(words: list[str], exponent: int = 4, length: int = 6) -> list[tuple[int, int, int]]:
    numbers: dict[str, int] = {}
    return find_runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), exponent, length)


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, of every run only the first period, joined by spaces."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        gone[start + period] += 1
        gone[start + size] -= 1
    return " ".join([w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4,
                  length: int = 6) -> DataFrame:
    """``id_col, runs`` (array of ``start, length, period``, in words, by
    start and period), ``collapsed`` (the text with one period of every run)."""
    python_ready(docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema[0].dataType
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                all_runs, texts = [], []
                for text in some.column(1).to_pylist():
                    words = _words(text or "")
                    runs = runs_of_words(words, exponent, length)
                    all_runs.append([dict(zip(RUN.names, r, strict=True)) for r in runs])
                    texts.append(collapse(words, runs) if runs else " ".join(words))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(all_runs, run_type), pa.array(texts, pa.string())],
                                                 [id_col, "runs", "collapsed"])

    return rows.mapInArrow(run, T.StructType([T.StructField(id_col, id_type), T.StructField("runs", T.ArrayType(RUN)),
                                              T.StructField("collapsed", T.StringType())]))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest of them, and digests of :func:`periodic_runs`' rows."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                               (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    rows = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(id_col, "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.period")).alias("period"),
                       F.expr("1000L * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col`` of all documents; in those whose identifier has a
    CRC-32 ``h`` (of its decimal digits) with ``h % 10 = 0``, every word from
    ``a`` on repeats the ``p`` words from there (``g = floor(h / 10)``,
    ``a = g % n``, ``p = 1 + floor((n - a) / (3 + g % 8))``)."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    hit = docs.select(F.col(id_col), F.col(text_col), h.alias("h"),
                      F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(f"({WORD})"))).alias("w"))
    n, g = F.size("w"), F.expr("h div 10")
    placed = hit.select(id_col, text_col, "w", n.alias("n"), g.alias("g"))
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    cycle = "slice(w, a + 1, p)"
    repeated = F.expr(f"concat(slice(w, 1, a), slice(flatten(array_repeat({cycle}, cast(1 + (n - a) div p as int))), 1, n - a))")
    return placed.select(id_col, F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col(text_col)).alias(text_col))
