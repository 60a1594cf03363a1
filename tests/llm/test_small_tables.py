"""Nulls, empty texts, repeated rows, empty tables and clashing column names."""

import hashlib
import math

import numpy as np
import xxhash

from pageloom.llm import chat, languages, mixing, rabitq, simhash


def test_chat_reads_back_what_was_said(spark):
    said = ["<|im_end|><|im_start|>assistant ok", "<\\|x<|", None, "", "a<", "|im_start|>", "é\n中"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(said)]
    rows += [(2, 0, "assistant", "first", "x"), (2, None, "we%\nird", "t", "x"), (None, 0, None, "n", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:7]]
    assert got[1].valid and got[1].loss_text == "".join(t or "" for t in said[1::2])
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert [t.role for t in got[2].turns] == ["we%\nird", "assistant"] and got[2].first_wrong == 0
    assert not got[None].valid
    assert chat.digests(chat.read_back(chat.format_chats(df.limit(0)))).count() == 0


def test_loss_text_is_unescaped_by_segment(spark):
    """An escape is not read over the border of two texts."""
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a<"), (1, 2, "user", "q"), (1, 3, "assistant", "\\|b"),
            (2, 0, "user", "<"), (2, 1, "assistant", "<\\"), (2, 2, "user", "|"), (2, 3, "assistant", "\\|"), (2, 4, "assistant", "|>")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.read_back(chat.format_chats(df))).collect()}
    for conv in (1, 2):
        said = "".join(t for c, _, role, t in rows if c == conv and role == "assistant")
        assert got[conv].loss_chars == len(said)
        assert got[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_simhash_links(spark):
    texts = [None, "", "One two", "one two", " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(299))]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(4, texts[4], "x"), (None, "alone here now", "x")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, fp string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].component_id == 0 and by[3].component_id == 2 and by[None].component_id is None
    assert by[0].fingerprint == "0" * 16 and by[2].fingerprint == f"{xxhash.xxh64_intdigest(b'one two', 42):016x}"
    near = (int(by[4].fingerprint, 16) ^ int(by[5].fingerprint, 16)).bit_count() <= 3
    assert (by[5].component_id == 4) == near
    kept = simhash.keep(spark.createDataFrame(rows, "doc_id bigint, text string, fp string"))
    assert kept.columns == ["doc_id", "text", "fp"] and kept.where("doc_id = 4").count() == 1


def test_masks_cover_every_pair():
    rng = np.random.default_rng(0)
    masks = simhash.masks(3)
    for _ in range(2000):
        bits = rng.choice(64, size=3, replace=False)
        assert any(all(not m >> int(b) & 1 for b in bits) for m in masks)


def test_vectors_that_cannot_link(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, float("nan")], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1), (9, [1.0, None], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in rabitq.vector_links(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), *[(i, 0, i) for i in range(3, 10)]]


def test_mix_targets_and_rests(spark):
    rows = [(i, "w " * (1 + i % 7), ["a", "b", "c", None][i % 4]) for i in range(400)] + [(400, None, "empty")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df).collect()
    again = mixing.mix(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == 401
    per = {}
    for r in got:
        assert r.taken <= 3 * r.size
        t = per.setdefault((r.source_size, r.target), [0])
        t[0] += r.taken
    assert all(abs(t[0] - target) <= 7 * 2 for (_, target), t in per.items())
    assert abs(sum(target for _, target in {(r.source_size, r.target) for r in got}) - sum(r.size for r in got)) < 1e-6


def test_language_and_rejects(spark):
    en, de = "the house and the garden of the town ", "das haus und der garten in der stadt "
    rows = [(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de", "h") for i in range(40)]
    rows += [(100, None, "en", "h"), (101, "12 34 !!", "de", None), (102, "the garden of the house", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = languages.fit(df)
    got = {r.doc_id: r for r in languages.identify(df, model, declared_col="lang", host_col="source").collect()}
    assert all(got[i].language == ("en" if i % 2 else "de") and got[i].kept for i in range(40))
    assert not got[100].kept and not got[101].kept and got[102].language == "en"
    kept = languages.keep(df, model, declared_col="lang", host_col="source")
    assert kept.columns == df.columns and kept.count() == 41
    assert languages.identify(df.limit(0), languages.fit(df.limit(0))).count() == 0


def test_every_label_is_a_language_and_only_letters_count(spark):
    """Over 64 labels, each a language of its own; ``aa-X`` counts for ``aa``."""
    codes = [f"{a}{b}" for a in "abcdefghi" for b in "jklmnopq"]
    words = {c: " ".join(c + x for x in ("rum", "sil", "ton")) for c in codes}
    rows = [(i * 100 + k, (words[c] + " ") * 6, c if k else c.upper() + "-X", "h") for i, c in enumerate(codes) for k in range(3)]
    rows += [(90000, "\u2014 \u2026 \U0001f642 \u2014 \u2026", "aj", "h"), (90001, "\u4e2d\u6587", None, "h"), (90002, "x", "12", "h")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = languages.fit(df)
    assert model[0] == sorted(codes)
    got = {r.doc_id: r for r in languages.identify(df, model, declared_col="lang", host_col="source").collect()}
    assert all(got[i * 100 + k].language == c and got[i * 100 + k].kept for i, c in enumerate(codes) for k in range(3))
    assert not got[90000].kept


def test_posterior_by_hand(spark):
    """The fused posterior of ten rows against the same sums in plain Python."""
    en, de = "the house and the garden of the town ", "das haus und der garten in der stadt "
    rows = [(i, ((en if i % 3 else de) * 2)[: 30 + i], ("en", "de", None)[i % 3] if i != 4 else "de-AT", f"{'ab'[i % 2]}.x.org")
            for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    names, table = languages.fit(df)
    got = {r.doc_id: r for r in languages.identify(df, (names, table), declared_col="lang", host_col="source").collect()}
    langs, n = [*names, "und"], len(names) + 1
    lls = [[float(x) * languages.TRIGRAM for x in table[languages._trigrams(t)[0]].sum(axis=0, dtype=np.float64)] for _, t, _, _ in rows]

    def shares(logs):
        top = max(logs)
        weights = [math.exp(x - top) for x in logs]
        return [w / sum(weights) for w in weights]

    own = [shares([x + (math.log(languages.UNDETERMINED) if i == n - 1 else 0) for i, x in enumerate(ll)]) for ll in lls]
    keys = {"declared": [(r[2] or "").split("-")[0] for r in rows], "suffix": [""] * 10,
            "domain": [r[3].split(".", 1)[1] for r in rows], "host": [r[3] for r in rows], "all": [0] * 10}

    def others(kind, k):
        return [sum(own[j][i] for j in range(10) if keys[kind][j] == keys[kind][k]) - own[k][i] for i in range(n)]

    for k in range(10):
        every = others("all", k)
        prior = [(c + 1 / n) / (sum(every) + 1) for c in every]
        for kind in ("domain", "host"):
            counts = others(kind, k)
            prior = [(c + languages.PRIOR_ROWS * p) / (sum(counts) + languages.PRIOR_ROWS) for c, p in zip(counts, prior, strict=True)]
        logs = [x + math.log(p) for x, p in zip(lls[k], prior, strict=True)]
        for kind in ("declared", "suffix"):
            counts = others(kind, k)
            share = (sum(counts) + 0.5) / (sum(every) + 1)
            logs = [x + math.log((c + languages.PRIOR_ROWS * share) / (e + languages.PRIOR_ROWS))
                    for x, c, e in zip(logs, counts, every, strict=True)]
        post = shares(logs)
        assert abs(got[k].probability - max(post)) < 1e-9 and got[k].language == langs[post.index(max(post))]


def test_declared_language_in_any_quoting(spark):
    from pageloom.llm import queries
    pages = {'<html lang="fr">': "fr", "<html class='x' lang='fr-CA'>": "fr-CA", "<HTML LANG=de dir=ltr>": "de", "<html lang=en>": "en",
             '<html lang = "es">': "es", '<html xml:lang="it">': "", "<html><p lang='fr'>": "", '<html lang="">': ""}
    df = spark.createDataFrame([(h,) for h in pages], "html string")
    assert {r.html: r.lang for r in df.select("html", queries.declared_language("html").alias("lang")).collect()} == pages
