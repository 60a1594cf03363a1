"""Operator 13: its gradients, windows, scores against a plain loop, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from pageloom.llm import toxicity as X


def test_gradients():
    rng, words = np.random.default_rng(0), ["idiot", "the", "a", "foo", "bar's", "x"]
    net = X.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    at, there = rng.integers(0, 6, (3, 5)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [0, 0, 0, 0, 0]], bool)
    slope = np.array([1.0, -2.0, 0.5])

    def loss():
        return float(net.forward(net.projected(net.inputs(*X.buckets_of(words))["x"]), at, there) @ slope)

    made, trace = net.inputs(*X.buckets_of(words)), []
    net.forward(net.projected(made["x"]), at, there, trace)
    grads = net.backward(made, at, there, trace, slope)
    assert grads.keys() == net.p.keys()
    for name, values in net.p.items():
        moved = np.argwhere(np.abs(grads[name]) > 1e-6)
        assert len(moved)
        for place in map(tuple, moved[rng.permutation(len(moved))[:4]]):
            before, sides = values[place], []
            for step in (1e-3, -1e-3):
                values[place] = before + step
                sides.append(loss())
            values[place] = before
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(grads[name][place], rel=2e-2, abs=2e-3), name


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 71, 72, 73, 500):
        docs, starts = X.windows_of([n])
        assert len(starts) == len(docs) >= 1
        covered = {i for s in starts.tolist() for i in range(s, min(s + X.WINDOW, n))}
        assert covered == set(range(n)) and max(starts) + X.WINDOW >= n
        assert all(b - a <= X.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def plain_score(net, text):
    """One window at a time, one word at a time."""
    p, words = {k: v.astype(np.float64) for k, v in net.p.items()}, X.words_of(text)
    n = len(words)
    starts = sorted({0, *range(0, n - X.WINDOW, X.STRIDE), max(n - X.WINDOW, 0)})
    odds = 0.0
    for s in starts:
        xs = []
        for w in words[s:s + X.WINDOW]:
            word, gram, _ = X.buckets_of([w])
            xs.append(np.concatenate([p["words"][word[0]], p["grams"][gram].mean(axis=0) if len(gram) else np.zeros(X.WIDTH)]))
        states = np.zeros((len(xs), 2 * X.STATES))
        for d in (0, 1):
            h = np.zeros(X.STATES)
            for t in range(len(xs)) if d == 0 else range(len(xs) - 1, -1, -1):
                given, carried = xs[t] @ p[f"in{d}"] + p[f"base{d}"], h @ p[f"state{d}"]
                z, r = (1 / (1 + np.exp(-(given + carried)[i * X.STATES:(i + 1) * X.STATES])) for i in (0, 1))
                new = np.tanh(given[2 * X.STATES:] + r * carried[2 * X.STATES:])
                h = states[t, d * X.STATES:(d + 1) * X.STATES] = (1 - z) * new + z * h
        pooled = np.zeros(2 * X.STATES)
        if xs:
            share = np.exp(np.tanh(states @ p["look"]) @ p["seek"])
            pooled = share @ states / share.sum()
        odds += np.exp(pooled @ p["out"] + p["bias"][0])
    return odds / (1 + odds)


SAID = ["idiot", "moron", "scum"]


def made_rows(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        words = ["".join(rng.choice("aeiou") + rng.choice("bdgln") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 160))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice([*SAID, "veque" + rng.choice("aeiou") * 2]))
        yield i, " ".join(words), int(toxic)


@pytest.fixture(scope="module")
def trained():
    rows = list(made_rows(300, 1))
    return X.train([t for _, t, _ in rows], [y for _, _, y in rows], steps=80)


def test_it_learns_and_leaves_the_rest_alone(trained):
    rows = list(made_rows(120, 2))
    docs, _, logits = X.Scorer(trained).score([t for _, t, _ in rows])
    found = X.document_logits(logits, docs, len(rows)) > 0
    assert (found == np.array([y for _, _, y in rows], bool)).mean() > 0.95


def test_scores_equal_the_plain_loop(trained):
    texts = [None, "", "a", "idiot", "x" * 100, " ".join(["fine words"] * 200) + " moron", "\u00e9\U0001f642 \u4e2d", *(t for _, t, _ in made_rows(10, 3))]
    scorer = X.Scorer(trained)
    docs, _, logits = scorer.score(texts)
    got = X._sigmoid(X.document_logits(logits, docs, len(texts)))
    assert got.tolist() == pytest.approx([plain_score(trained, t) for t in texts], abs=1e-4)
    scorer.numbers.clear()  # as when its memory is full
    docs, _, again = scorer.score(texts[::-1])
    assert X._sigmoid(X.document_logits(again, docs, len(texts)))[::-1].tolist() == pytest.approx(got.tolist(), abs=1e-5)


def test_rows(spark, trained, monkeypatch):
    monkeypatch.setattr(X, "train", lambda texts, labels: trained)
    rows = [(i, t, 1, "x") for i, t, _ in made_rows(40, 5)]
    rows += [(40, None, 0, "x"), (41, "", 0, "x"), (None, "idiot", 0, "x"), (3, rows[3][1], 9, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, score string")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in made_rows(40, 5)] + [(None, 0, 1), (41, 1, None)], "doc_id bigint, quality int, toxic int")
    model = X.fit(df, labels)
    usable = [y for i, _, y in made_rows(40, 5) if zlib.crc32(str(i).encode()) % 5]
    assert model[1] == sum(usable) / len(usable)
    scored = X.score(df, model)
    assert [len(r.windows) for r in scored.where("doc_id >= 40").collect()] == [1, 1]
    got = X.verdicts(scored)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    prior = model[1] / (1 - model[1])
    for r in out:
        odds = plain_score(trained, next(t for i, t, _, _ in rows if i == r.doc_id))
        assert r.score == pytest.approx(odds * prior / (1 - odds + odds * prior), abs=1e-4)
    assert len({r.score for r in out if r.doc_id == 3}) == 1
    assert X.verdicts(X.score(df.limit(0), model)).count() == 0


def test_without_both_classes(spark):
    df = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id bigint, text string")
    for labels, share in (([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0)):
        model = X.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert model == (None, share)
        assert [r.score for r in X.score(df, model).collect()] == [share, share]


def test_only_labels_of_the_training_folds_are_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(X, "train", lambda texts, labels: seen.append(dict(zip(texts, labels, strict=True))))
    df = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id bigint, text string")
    X.fit(df, df.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic"))
    assert seen == [{f"text {i}": i % 2 for i in range(100) if zlib.crc32(str(i).encode()) % 5}]
