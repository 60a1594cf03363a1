import os
import random
from collections import Counter

import numpy as np
import pytest

from pageloom import session
from pageloom.llm import ppm


def test_what_it_writes_is_a_few_times_the_text(spark, tmp_path, monkeypatch):
    # every word stands after many others: a row for each word after the bytes before it is many times the text
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(tmp_path))
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(words, k=600))) for i in range(400)]
    size = sum(len(text) for _, text in docs)
    got = ppm.score(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2), across=True)
    assert got.count() == len(docs)
    written = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path) for f in files)
    assert written < 5 * size


@pytest.mark.parametrize("across", [True, False])
def test_keys_of_blocks_are_all_contexts(monkeypatch, across):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 40)
    rng = random.Random(6)
    texts = [b" ".join(rng.choices([b"a", b"the", "\u4e2d".encode(), b"x" * 20, b"\xff\x00"], k=rng.randint(0, 9))) for _ in range(30)]
    blocks = list(ppm._blocks(texts, [7] * len(texts), across))
    assert len(blocks) > 3 and [n for _, lengths in blocks for n in lengths] == [len(x) + 1 + bool(x) for x in texts]
    keys = ppm._mixed(np.concatenate([k for k, _ in blocks]), ppm._UNMIX).tolist()
    want = []
    for text in texts:
        spelled = b"     \x07 " + (text + b" " if text else b"") + b"\n"
        start = ppm.ORDER
        for p in range(ppm.ORDER, len(spelled)):
            if not across and spelled[p - 1] == 32:
                start = p
            before = spelled[p - ppm.ORDER:p] if across else (spelled[:ppm.ORDER] + spelled[start:p])[-ppm.ORDER:]
            want.append(int.from_bytes(before[::-1] + spelled[p:p + 1], "big"))
    assert keys == want


def test_merged_in_parts_and_packed(monkeypatch):
    monkeypatch.setattr(ppm, "MERGED", 50)
    rng = np.random.default_rng(7)
    parts, want = [], Counter()
    for _ in range(40):
        keys = np.unique(rng.integers(0, 500, 30)).astype(np.uint64) << np.uint64(50)
        counts = rng.integers(0, 3, len(keys))
        parts.append((keys, counts))
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            want[k] += c
    keys, counts = ppm._merged(iter(parts))
    assert keys.tolist() == sorted(want) and counts.tolist() == [want[k] for k in sorted(want)]
    for values in (keys, counts, np.zeros(0, np.int64), np.array([-1.5, 0.0, 1e300]), np.array([255, 256, 1 << 40])):
        assert ppm._unpacked(ppm._packed(values), len(values), values.dtype).tolist() == values.tolist()
