"""Operators 3, 6, 7 and 8 and the whole pipeline against brute force."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from pageloom.llm import exact, mixing, rabitq, simhash
from pageloom.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(n, linked):
    """Smallest reachable number per node; ``linked(i, j)`` for i < j."""
    low = list(range(n))
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if linked(i, j)]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            least = min(low[i], low[j])
            changed |= low[i] != least or low[j] != least
            low[i] = low[j] = least
    return low, pairs


# --- operator 3 ----------------------------------------------------------------

def fill(sizes):
    """Targets by resharing the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, free = set(), set(names)
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] for s in full} | share
        full, free = full | above, free - above


def mix(rows, quality):
    """``(doc_id, text, source)`` rows: id to ``(size, source_size, target, taken)``."""
    size = {d: len(WORD.findall(t or "")) for d, t, _ in rows}
    per = Counter()
    for d, _, s in rows:
        per[s] += size[d]
    target, out = fill(per), {}

    def key(d):
        digest = hashlib.md5(f"0:{d}:{size[d]}".encode()).hexdigest()
        return -math.log((int(digest[:13], 16) + 1) / 2 ** 52) / {None: 1.0, 1: 2.0, 0: 0.5}[quality.get(d)]

    for s in per:
        order = sorted((d for d, _, source in rows if source == s), key=key)
        whole = math.floor(target[s] / per[s]) if per[s] else 0
        rest, before, once = target[s] - whole * per[s], 0, set()
        for d in order:
            before += size[d]
            if size[d] and whole < 3 and before <= rest:
                once.add(d)
        gap, filled = rest - sum(size[d] for d in once), 0
        for d in order:
            if d not in once and size[d] and whole < 3 and size[d] <= gap:
                if filled + size[d] / 2 <= gap:
                    once.add(d)
                filled += size[d]
        for d in order:
            out[d] = (size[d], per[s], target[s], size[d] * (whole + (d in once)))
    return out


def test_mix_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, "wörd x " * rnd.randint(0, 9), rnd.choice(["a", "b", "c", "d", None, "Z", "é"] + ["e"] * 6)) for i in range(500)]
    rows += [(900, None, "empty"), (901, "one", "tiny"), (902, " ".join(["x"] * 700), "long")]
    labels = [(i, i % 2) for i in range(0, 500, 3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"),
                     spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    want = mix(rows, dict(labels))
    assert len(got) == len(rows) and any(t == 3 * n > 0 for _, n, t, _ in want.values())
    for r in got:
        size, source_size, target, taken = want[r.doc_id]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken), r
        assert r.target == pytest.approx(target)


# --- operator 6 ----------------------------------------------------------------

def kept_of(rows):
    """``(doc_id, text)`` rows by normal text: the smallest id, and how many."""
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    low = {t: min((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    return sorted((str(d), str(low[n]), len(groups[n])) for d, t in rows for n in [re.sub(r"[\x20\x09-\x0D]+", " ", t or "")])


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup_of_odd_rows(spark, tmp_path, monkeypatch, clash):
    """Null and repeated ids, repeated rows, clashing column names; with
    ``clash`` texts of one length have one digest."""
    rows = [(5, "a  b"), (3, "a\tb"), (3, "a\tb"), (None, "a b"), (None, "only"), (7, None), (8, ""), (9, " "), (10, "c d"), (11, "x" * 9000),
            (12, "x" * 9000), (13, "a b"), (None, "e"), (None, "e")]
    table = spark.createDataFrame([(*r, "x", 1, "y", True) for r in rows], "doc_id bigint, text string, digest string, n int, at string, kept boolean")
    table.repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    if clash:
        def weak(table, id_col, text_col):
            return plain(table, id_col, text_col).withColumn("digest", F.length(exact.normal(F.col("text"))).cast("string"))
        plain = exact._rows
        monkeypatch.setattr(exact, "_rows", weak)
    got = exact.exact_dedup(spark, str(tmp_path / "t.parquet")).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == kept_of(rows)
    assert sum(r.kept for r in got) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})
    table.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    assert exact.exact_dedup(spark, str(tmp_path / "none.parquet")).count() == 0


# --- operator 7 ----------------------------------------------------------------

def test_vector_links_equal_brute_force(spark):
    """Vectors that are near but not parallel, on both sides of the threshold."""
    rng = np.random.default_rng(5)
    rows = []
    for centre in rng.normal(size=(25, 64)):
        centre /= np.linalg.norm(centre)
        for spread in rng.uniform(0.05, 0.3, size=14):
            noise = rng.normal(size=64)
            rows.append(((centre + spread * noise / np.linalg.norm(noise)) * rng.uniform(0.1, 9)).tolist())
    labels = [i % 2 for i in range(len(rows))]
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    cosine = unit @ unit.T
    low, pairs = closure(len(rows), lambda i, j: labels[i] == labels[j] and cosine[i, j] >= 0.98)
    links = Counter(k for p in pairs for k in p)
    below = sum(0.95 < cosine[i, j] < 0.98 for i in range(len(rows)) for j in range(i))
    assert len(pairs) > 100 and below > 100
    df = spark.createDataFrame([(i, v, labels[i]) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rabitq.vector_links(df, threshold=0.98).collect()}
    assert got == {i: (links[i], low[i], low[i] == i) for i in range(len(rows))}


# --- operator 8 ----------------------------------------------------------------

def test_simhash_components_equal_brute_force(spark):
    """Fingerprints planted 1 to 5 bits apart, alone and in chains."""
    rnd = random.Random(6)
    prints = {0, (1 << 64) - 1, 0b111, 0b1111000}
    for _ in range(60):
        at = rnd.getrandbits(64)
        prints.add(at)
        for _ in range(rnd.randint(0, 6)):
            flipped = at
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                flipped ^= 1 << bit
            prints.add(flipped)
            at = rnd.choice([at, flipped])
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    low, pairs = closure(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert len(pairs) > 40
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), 3)
    root = {r.node: r.root for r in components(links, "test-links").collect()}
    got, want = {}, {}
    for p, k in zip(signed, low, strict=True):
        got.setdefault(root.get(p, p), set()).add(p)
        want.setdefault(k, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


# --- the pipeline ----------------------------------------------------------------

def pipeline(rows, quality):
    """All five stages in plain Python; every text with letters is English,
    and no two different lines are near each other."""
    docs = [(d, t, s) for d, t, _, s in rows if t and re.search("[a-z]", t)]
    seen, lined = set(), []
    for d, text, s in docs:
        lines = [x for x in text.split("\n") if not (x in seen or seen.add(x))]
        lined.append((d, "\n".join(lines), s))
    prints = [simhash.fingerprint(t, 3) for _, t, _ in lined]
    low, _ = closure(len(lined), lambda i, j: (int(prints[i]) ^ int(prints[j])).bit_count() <= 3)
    alone = [row for i, row in enumerate(lined) if low[i] == i]
    mixed = mix(alone, quality)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, text, _ in alone:
        ids = coder.encode_ordinary(text)
        row = (d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        out += [row] * (mixed[d][3] // mixed[d][0] if mixed[d][0] else 0)
    return sorted(out)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    vocabulary = ["the", "house", "and", "garden", "of", "town", "river", "stone", "bread", "winter", "summer", "field", "green", "old"]

    def line():
        return " ".join(rnd.choice(vocabulary) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(9, 25)))

    shared = [line() for _ in range(4)]
    rows = [(i, "\n".join([line() for _ in range(rnd.randint(1, 5))] + rnd.sample(shared, rnd.randint(0, 2))), "en",
             rnd.choice(["a", "a", "a", "b", None])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "c") for i in range(0, 20, 4)] + [(200, None, "en", "a"), (201, "12 34", "en", "a")]
    long = [line().split() for _ in range(40)]
    rows += [(300 + k, "\n".join(" ".join(words) + (f" tail{k} x{k} y{k} z{k}" if k else "") for words in long), "en", "b") for k in range(2)]
    quality = {i: i % 2 for i in range(0, 60, 3)}
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(quality.items()), "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == pipeline(rows, quality)
