import hashlib

import corpus_pipeline


def test_stages_on_a_small_table(spark, tmp_path):
    sf = str(tmp_path)
    base = {i: " ".join(f"the{i} and{i * 7 % 13} of{j} garden{i * j % 17}" for j in range(12)) for i in range(12)}
    rows = [(i, t, "en", f"s{i % 3}", 1) for i, t in base.items()]
    rows += [(100, base[3], "en", "s0", 1), (101, None, "en", "s1", 1), (102, f"{base[5]}\nnew line here", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, times int")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int").write.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, docs, sf)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {*range(12), 100, 102}
    two = {r.doc_id: r.text for r in stages["line_dedup"](spark, one, sf).collect()}
    assert two == {**base, 100: "", 102: "new line here"}
    three = stages["simhash_near_dedup"](spark, docs.where("text is not null"), sf)
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} >= {0, 1, 2, 3} and three.where("doc_id = 100").count() == 0
    four = stages["mix_sources"](spark, docs, sf)
    assert four.columns == docs.columns and four.groupBy("doc_id").count().where("count > 3").count() == 0
    want = {hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows}
    assert {r.decoded_sha256 for r in stages["byte_bpe"](spark, docs, sf).collect()} == want
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
