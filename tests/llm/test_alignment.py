"""Operator 12 against brute force with the libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pageloom.llm import alignment

PATHS = alignment.default_tokenizers()
TEXTS = [None, "", "a", " a", "a ", "  a  b ", "\n\nfoo  bar\n x", "a\u2581b", "x\u2581 y", "<s> </s><|endoftext|> <0x41>", "\x00 \x1c x\x85y",
         "\u00e9\u4e2d\U0001f642 \ufb01 \u3000 z", "don't we'll I'd 's", " ", "  a  ", "word, word; wo\u0301rd.\nWord", "long" * 40 + " " + "x" * 90]


@pytest.fixture(scope="module")
def aligner():
    with open(PATHS[0], encoding="utf-8") as f, open(PATHS[1], "rb") as g:
        return alignment.Aligner(f.read(), g.read())


class Brute:
    """Whole texts, byte sets per token."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def __call__(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spells_a = [bytes(self.alphabet[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        spells_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("\u2581", " ").encode() for p in pieces]
        if not b"".join(spells_a) == b"".join(spells_b) == (" " + text).encode():
            return None
        at_a = [i for i, s in enumerate(spells_a) for _ in s]
        at_b = [i for i, s in enumerate(spells_b) for _ in s]
        links = list(dict.fromkeys(zip(at_a, at_b, strict=True)))
        groups, now, n = [], ([], []), len(at_a)
        for k in range(n):
            for side, at, ids in ((0, at_a, a), (1, at_b, b)):
                if k == 0 or at[k] != at[k - 1]:
                    now[side].append(str(ids[at[k]]))
            if k == n - 1 or (at_a[k] != at_a[k + 1] and at_b[k] != at_b[k + 1]):
                groups.append(",".join(now[0]) + "|" + ",".join(now[1]))
                now = ([], [])
        return len(a), len(b), len(groups), ";".join(groups), [(a[i], b[j]) for i, j in links]


@pytest.fixture(scope="module")
def brute():
    return Brute()


def odd_texts(n, seed):
    rng = random.Random(seed)
    chars = "abcthe     \n\t\u00e9\u4e2dx9!,.'s \x1c\r\u00b2<>| \u180e\u200b\ufeff\u3000'"
    return ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_parts_align_as_whole_texts_do(aligner, brute):
    texts = TEXTS + odd_texts(3000, 3)
    for k in range(0, len(texts), 200):
        for text, parts in zip(texts[k:k + 200], aligner.align(texts[k:k + 200]), strict=True):
            wanted = brute(text)
            assert (wanted is None) == (parts is None), text
            if wanted:
                assert tuple(sum(p[i] for p in parts) for i in range(3)) == wanted[:3]
                assert ";".join(p[3] for p in parts) == wanted[3]
                pairs = np.frombuffer(b"".join(p[4] for p in parts), np.int64).tolist()
                assert [(p >> 32, p & 0xFFFFFFFF) for p in pairs] == wanted[4]


@pytest.mark.parametrize("size", [1, 17, 300, 5000])
def test_bitmaps_hold_every_entry(size):
    rng = np.random.default_rng(size)
    n = size * 4
    keys = np.unique(rng.zipf(1.3, n).clip(max=60) * size + rng.integers(0, size, n))
    pairs, docs = keys // size, (keys % size).astype(np.int32)
    times = rng.geometric(0.4, len(keys)).astype(np.int32)
    by_doc = np.lexsort((pairs, docs))  # as documents are read
    found = alignment.bitmaps(pairs[by_doc], docs[by_doc], times[by_doc], size)
    row, doc, weight = alignment.set_bits(found["planes"], found["span"])
    got = collections.Counter()
    for r, d, w in zip(row.tolist(), doc.tolist(), weight.tolist(), strict=True):
        got[found["pair"][r].as_py(), d] += w
    assert got == dict(zip(zip(pairs.tolist(), docs.tolist(), strict=True), times.tolist(), strict=True))
    assert found["docs"].to_pylist() == [int((pairs == p).sum()) for p in found["pair"].to_pylist()]
    assert found["links"].to_pylist() == [int(times[pairs == p].sum()) for p in found["pair"].to_pylist()]


def expected(rows, brute):
    found = [(i, brute(t)) for i, t in rows]
    counts = collections.Counter(p for _, f in found if f for p in f[4])
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        out.append((i, f[0], f[1], f[2], len(f[4]), hashlib.sha256(f[3].encode()).hexdigest(),
                    sum(counts[p] == top[p[1]] for p in f[4]), sum(counts[p] for p in f[4])))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_rows(spark, brute):
    rows = list(enumerate(TEXTS + odd_texts(300, 8))) + [(2, "a"), (2, "a"), (None, "the word")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, pair int, block string").repartition(3)
    got = alignment.digests(df, *PATHS)
    assert got.columns == COLUMNS and {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, brute)
    assert alignment.digests(df.limit(0), *PATHS).count() == 0
    zero = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, alignment.digests(zero, *PATHS).collect())) == [(i, 0, 0, 0, 0, "", 0, 0) for i in (1, 2)]


def test_many_blocks(spark, brute):
    """Rows of one partition spread over several blocks; scores count all of them."""
    rows = [(i, "the same words again and again " + " ".join(f"w{(i * 7 + k) % 501}" for k in range(40))) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    indexed = alignment.index(df, *PATHS, entries=5000)
    assert indexed.select("block").distinct().count() > 2
    scores = alignment.pair_scores(indexed)
    got = alignment.document_scores(indexed, scores)
    wanted = {r[0]: r for r in expected(rows, brute)}
    assert {r.doc_id: (r.n_best, r.count_sum) for r in got.collect()} == {i: w[6:] for i, w in wanted.items()}
    per_pair = collections.defaultdict(lambda: [0, 0])
    for _, t in rows:
        for p, n in collections.Counter(brute(t)[4]).items():
            per_pair[p][0] += 1
            per_pair[p][1] += n
    assert {(r.a, r.b): [r.docs, r.links] for r in scores.collect()} == per_pair


def test_alignments_as_rows(spark, brute):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in alignment.alignments(spark.createDataFrame(rows, "doc_id bigint, text string"), *PATHS).collect()}
    for i, t in rows:
        wanted = brute(t)
        assert got[i].groups == (wanted[3] if wanted else "")
        assert {(x.a, x.b): x.times for x in got[i].links} == (collections.Counter(wanted[4]) if wanted else {})
