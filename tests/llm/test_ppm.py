import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from pageloom.llm import ppm

K = ppm.ORDER


def spelled(kind, word):
    start = b" " * (K - 2) + bytes([zlib.crc32(kind.encode()) % 256]) + b" "
    return start + (b"\n" if word is None else word + b" ")


def brute(docs):
    """score and base_score per document, from a dictionary trie."""
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t, _ in docs}
    train = [i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 10]
    kind = {i: k or "" for i, _, k in docs}
    plain, trie, pairs, kinds = Counter(), defaultdict(Counter), Counter(), Counter()
    for i in train:
        plain.update(tokens[i])
        pairs.update((kind[i], w) for w in tokens[i])
        kinds[kind[i]] += 1
    for (k, w), c in pairs.items():
        s = spelled(k, w)
        for p in range(K, len(s)):
            for j in range(K + 1):
                trie[s[p - j:p]][s[p]] += c

    def group(order, n, d):
        return order, min(n.bit_length(), ppm.ESCAPES[0]), min(d, ppm.ESCAPES[1])

    taken, of = Counter(), Counter()
    for ctx, after in trie.items():
        n, d = sum(after.values()), len(after)
        for c in after.values() if n > 1 else ():
            g = group(len(ctx), n - 1, d - (c == 1))
            taken[g] += c * (c == 1)
            of[g] += c

    def logp(ctx, byte):
        gone, acc = set(), 0.0
        for j in range(K, -1, -1):
            after = {b: c for b, c in trie.get(ctx[K - j:], {}).items() if b not in gone}
            if not after:
                continue
            n, d = sum(after.values()), len(after)
            g = group(j, n, d)
            e = (taken[g] + d / (n + d)) / (of[g] + 2)
            if byte in after:
                return acc + math.log10((1 - e) * after[byte] / n)
            acc += math.log10(e)
            gone |= set(after)
        return acc - math.log10(ppm.SYMBOLS - len(gone))

    n, v = sum(plain.values()), len(plain)
    out = {}
    for i, ts in tokens.items():
        score = 0.0
        for w in ts:
            s = spelled(kind[i], w)
            score += sum(logp(s[p - K:p], s[p]) for p in range(K, len(s)))
        score += math.log10((kinds[kind[i]] + 0.5) / (sum(kinds.values()) + 128))
        out[i] = (score, sum(math.log10((plain[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts), len(ts),
                  sum(w in plain for w in ts), n)
    alphabet = [b for b in range(256) if b not in b"\x09\x0b\x0c\x0d"]
    for ctx in random.Random(1).sample(sorted(trie), min(20, len(trie))):
        full = ctx.rjust(K)
        assert sum(10 ** logp(full, b) for b in alphabet) == pytest.approx(1, abs=1e-9)
    return out


def test_scores_equal_a_dictionary_trie(spark):
    rng = random.Random(3)
    words = ["The", "thé", "tion", "ou", "haus", "hauses", "中文", "x" * 30, "ÿ\x00", "a"]
    docs = [(i, " \t\n".join(rng.choices(words, k=rng.randint(0, 30))) if i % 9 else None, rng.choice(["en", "de", None]))
            for i in range(60)]
    docs.append((60, "only here: zyx " * 3, "fr"))
    want = brute(docs)
    got = ppm.score(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), class_col="lang").collect()
    assert len(got) == len(docs)
    for r in got:
        score, base, n, known, total = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_small_and_odd_tables(spark):
    schema = "doc_id bigint, text string, c string, word string"
    assert ppm.score(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b", "x", "w"), (1, "a b", "x", "w"), (1, "a b", "x", "w"), (2, "", None, None)]
    got = ppm.score(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and all(r.score < 0 for r in got)
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    alone = ppm.score(spark.createDataFrame([(i, "ab", "x", "w") for i in held], schema)).collect()
    assert [round(r.score, 9) for r in alone] == [round(-4 * math.log10(ppm.SYMBOLS), 9)] * 3  # a, b, word end, text end
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in alone)


def test_contexts_of_seven_bytes_count(spark):
    # the last byte of either word is told by the byte seven places before it alone
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10][:40]
    docs = [(i, "1abcdefx" if n % 2 else "2abcdefy") for n, i in enumerate(train)]
    docs += [(held[0], "1abcdefx"), (held[1], "1abcdefy")]
    got = {r.doc_id: r.score for r in ppm.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 0.5
