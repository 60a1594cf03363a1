"""Operator 11 against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from pageloom.llm import periods


def brute_lyndon(x):
    out = []
    for i in range(len(x)):
        j = i + 1
        while j < len(x) and x[i:] < x[j:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(x, exponent, length):
    n, out = len(x), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            size = i + q - s
            smaller = any(all(x[k] == x[k + d] for k in range(s, s + size - d)) for d in range(1, q))
            if size >= max(length, exponent * q) and not smaller:
                out.append((s, size, q))
    return sorted(out)


def sequences(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        k, size = rng.choice([1, 2, 2, 3, 5]), rng.randint(1, 40)
        x = [rng.randrange(k) for _ in range(size)]
        if rng.random() < 0.5:
            a = rng.randrange(size)
            p = 1 + (size - a) // rng.randint(2, 7)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(size)]
        yield x


def test_groups_give_the_lyndon_array():
    for x in sequences(1500, 1):
        assert periods.lyndon_lengths(x) == brute_lyndon(x), x


@pytest.mark.parametrize(("exponent", "length"), [(2, 2), (3, 1), (4, 6), (2, 6)])
def test_runs_equal_brute_force(exponent, length):
    for x in sequences(800, exponent * 10 + length):
        assert periods.find_runs(np.array(x), exponent, length) == brute_runs(x, exponent, length), x


def test_hashes_that_meet_decide_nothing():
    """Thue-Morse words are where sums of powers modulo 2^64 meet."""
    x = [0]
    while len(x) < 4096:
        x += [1 - v for v in x]
    found = periods.find_runs(np.array(x), 2, 2)
    for s, size, p in found:
        assert x[s:s + size - p] == x[s + p:s + size]
        assert (s == 0 or x[s - 1] != x[s + p - 1]) and (s + size == len(x) or x[s + size] != x[s + size - p])
    small = x[:256]
    assert periods.find_runs(np.array(small), 2, 2) == brute_runs(small, 2, 2)


def expected(doc_id, text, plant=True):
    words = periods._words(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 4, 6)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_rows(spark):
    rng = random.Random(7)
    texts = [None, "", " \t\n", "a", "a a a a a a", "a b " * 9, "x " + "a b c " * 5 + "y", "\u00a0a a\u00a0" * 6, "no runs at all here"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    rows = [(i, t, 1, "r") for i, t in enumerate(texts)] + [(4, texts[4], 2, "s"), (None, "q q q q q q q", 3, "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs int, runs string")
    found = periods.digests(periods.periodic_runs(periods.plant(df)))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in found.dtypes} == {"bigint", "string"}
    key = str
    assert sorted(map(tuple, found.collect()), key=key) == sorted([expected(i, t) for i, t, _, _ in rows], key=key)
    assert any(r[1] > 1 for r in (expected(i, t) for i, t, _, _ in rows))
    empty = df.limit(0)
    assert periods.digests(periods.periodic_runs(periods.plant(empty))).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(["w"] * 5 + [str(i % 997) for i in range(60000)] + ["x"] * 40)
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = periods.periodic_runs(df).first()
    assert [tuple(r) for r in row.runs] == [(5, 60000, 997), (60005, 40, 1)]
    assert row.collapsed.split(" ") == ["w"] * 5 + [str(i) for i in range(997)] + ["x"]
