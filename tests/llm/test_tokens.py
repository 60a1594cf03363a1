import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pageloom.llm import bpe, simple8b
from pageloom.llm.splits import TextCoder

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
TEXTS = [None, "", " ", "a", "  two  spaces ", "line\n next\n\n end \n", "don't we'll I'd", "x" * 3000, "ab" * 2000 + " c", " é中文 1234,5.",
         "tab\there \x1c\x85  x", "<|endoftext|> kept", "The,\nThe. the;the", "é" * 500]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcthe     \n\té中x9!,.'s \x1c\r²") for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_rank_queue_equals_tiktoken():
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    coder = TextCoder(P.PATTERN, bpe.Merger(RANKS).code, remember=50)
    for t in [*TEXTS, *odd_texts(3000, 5)]:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == own.encode_ordinary(t or ""), t


def test_rank_queue_on_a_vocabulary_with_lower_ranks_later():
    # abc has a lower rank than bc, which must be merged first to reach it
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")} | {b"abc": 3, b"bc": 4, b"ca": 5}
    own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks | {b" ": 6}, special_tokens={})
    merger, rng = bpe.Merger(ranks), random.Random(2)
    for _ in range(500):
        s = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        assert merger.merge(s.encode()) == own.encode_ordinary(s)


def test_bpe_rows(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(3, "a", 1, "x"), (None, "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, ids string")
    args = bpe.default_tokenizer()
    got = bpe.digests(bpe.round_trip(docs, *args)).collect()
    assert len(got) == len(rows)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for r, (i, t, _, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(rows, key=lambda r: (r[0] is None, r[0])), strict=True):
        ids = np.array(own.encode_ordinary(t or ""), "<u4").tobytes()
        assert (r.doc_id, r.n_tokens, r.ids_sha256) == (i, len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    decoded = bpe.decode(bpe.encode(docs, *args), args[0]).where("doc_id = 4").first().decoded
    assert bytes(decoded).decode() == TEXTS[4]
    assert bpe.round_trip(docs.limit(0), *args).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1) | st.integers(0, 70000) | st.just(0) | st.integers((1 << 60) - 2, (1 << 60) + 2), max_size=300),
       st.sampled_from([1, 3, 64, 4096]))
def test_simple8b_round_trip(values, block):
    v = np.array(values, np.uint64)
    words, starts = simple8b.pack(v, block)
    assert simple8b.unpack(words).tolist() == values
    cuts = [*starts.tolist(), len(words)]
    for k in range(len(starts)):
        assert simple8b.unpack(words[cuts[k]:cuts[k + 1]]).tolist() == values[k * block:(k + 1) * block]


def test_simple8b_packs():
    for count, width in zip(simple8b.COUNTS, simple8b.WIDTHS, strict=True):
        v = np.full(count, (1 << min(width, 52)) - 1, np.uint64)
        assert len(simple8b.pack(v)[0]) == 1
    ids = np.arange(10000, dtype=np.uint64)
    content = simple8b.file_bytes([ids[:3], ids[3:]], simple8b.pa.array(["a", "b"]))
    assert simple8b.read_block(content, 1).tolist() == list(range(4096, 8192))


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(simple8b, "FILE_IDS", 50)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    rng = random.Random(4)
    texts = [*TEXTS, *odd_texts(60, 9)]
    rows = [(i, t, "x") for i, t in zip(rng.sample(range(-500, 500), len(texts)), texts, strict=True)] + [(None, "null id", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(5)
    got = simple8b.digests(simple8b.token_files(docs, *simple8b.default_tokenizer())).collect()
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    empty = simple8b.token_files(docs.limit(0), *simple8b.default_tokenizer())
    assert empty.count() == 0 and empty.schema["doc_id"].dataType == docs.schema["doc_id"].dataType


def test_vocabularies_are_read_in_place():
    here = os.path.dirname(os.path.abspath(bpe.__file__))
    assert all(not p.startswith(here) for p in (bpe.default_tokenizer()[0], simple8b.default_tokenizer()[0]))


def test_added_tokens_in_a_text_get_their_ids(spark, tmp_path):
    from pageloom.llm import queries
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", " x <|endoftext|>  y\n", "a<|endoftext|", "plain words", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op10_token_files"](spark, str(tmp_path)).orderBy("doc_id").collect()
    want, start = [], 0
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
