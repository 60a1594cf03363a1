import zlib

import pytest

import test_ppm
from pageloom.llm import ppm

K = ppm.ORDER
HELD = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
TRAIN = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]


def test_a_shuffled_text_costs_more(spark):
    docs = [(i, "the cat sat on the mat") for i in TRAIN[:30]]
    docs += [(HELD[0], "the cat sat on the mat"), (HELD[1], "mat the on cat the sat")]
    got = {r.doc_id: r for r in ppm.score(spark.createDataFrame(docs, "doc_id bigint, text string"), across=True).collect()}
    a, b = got[HELD[0]], got[HELD[1]]
    assert a.base_score == pytest.approx(b.base_score) and a.score > b.score + 1


def test_across_equals_a_dictionary_trie(spark, monkeypatch):
    # the reference spells a word with a fixed start; here each word is spelled with the bytes before it
    texts = ["", "a b a b", "The thé haus", "haus ou tion ou haus", "x" * 12 + " a", "ou the a", "中文 a", None]
    docs = [(i, texts[i % len(texts)], "en" if i % 3 else None) for i in range(60)]
    spelled, words = [], {}
    for i, text, kind in docs:
        before = b" " * (K - 2) + bytes([zlib.crc32((kind or "").encode()) % 256]) + b" "
        words[i] = []
        for w in [*(text or "").encode().lower().split(), None]:
            spelled.append(before + (b"\n" if w is None else w + b" "))
            words[i].append(len(spelled) - 1)
            before = spelled[-1][-K:]

    class Numbered(bytes):
        """A text whose words are the numbers of its spelled words."""
        def encode(self):
            return self

        def lower(self):
            return self

        def split(self):
            return list(words[int(self)])

    # the end is a spelled word too: the reference adds one without a number, of no bytes
    monkeypatch.setattr(test_ppm, "spelled", lambda kind, at: b" " * K if at is None else spelled[at])
    want = test_ppm.brute([(i, Numbered(str(i).encode()), kind) for i, _, kind in docs])
    got = ppm.score(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), class_col="lang", across=True).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.n_tokens == len(words[r.doc_id]) and r.score == pytest.approx(want[r.doc_id][0])
