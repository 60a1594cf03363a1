"""Sources and sinks: literal seeds, line lists, raw bodies, text lines,
versioned writes, GB2312 decoding."""

import os

from pyspark.sql import functions as F

from conftest import SMOKE
from pageloom.operators import binary as BI
from pageloom.operators import hierarchy as HI
from pageloom.operators import tables as TB
from pageloom.operators.frontier import seed_pages
from pageloom.sources.tables import literal_seeds, read_lines, read_raw_bodies, read_table


def test_literal_seeds_join_pages(spark):
    pages = read_table(spark, SMOKE, "pages")
    urls = [r["url"] for r in pages.orderBy("page_id").limit(3).collect()] + ["http://absent.example/"]
    got = seed_pages(literal_seeds(spark, urls), pages).select("seed_pos", "page_id").collect()
    assert sorted(r["seed_pos"] for r in got) == [0, 1, 2]


def test_read_lines_strips(spark, tmp_path):
    p = tmp_path / "list.txt"
    p.write_text("  a  \n\tb\n\n c　\n", encoding="utf-8")
    assert [r["line"] for r in read_lines(spark, str(p)).collect()] == ["a", "b", "", "c"]


def test_raw_bodies_and_signature(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(bytes.fromhex("FFD8FF") + b"x" * 30)
    (tmp_path / "b.gif").write_bytes(b"GIF89a" + b"y" * 10)          # 16 bytes: too short
    (tmp_path / "c.html").write_bytes(b"<html>" + b"z" * 40)       # not an image
    bodies = read_raw_bodies(spark, str(tmp_path)).withColumn("page_id", F.lit(1))
    got = BI.image_signature(bodies).collect()
    assert [(r["kind"], r["n_bytes"]) for r in got] == [("jpeg", 33)]


def test_stat_lines_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id bigint, pid bigint")
    out = str(tmp_path / "lines")
    HI.save_lines(HI.stat_lines(HI.tree_stats(df)), out)
    got = sorted(r["value"] for r in spark.read.text(out).collect())
    assert got == ["1\t\t1", "2\t|1\t1", "3\t|1|2\t0"]


def test_write_version_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    p = TB.write_version(df, str(tmp_path / "t"), "1")
    assert os.path.isdir(p)
    try:
        TB.write_version(df, str(tmp_path / "t"), "1")
        raise AssertionError("second write of one version must fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)


def test_gb2312_round_trip_and_truncation(spark):
    df = spark.createDataFrame([(1, "简称人口"), (2, "面积")], "page_id int, t string")
    enc = df.select("page_id", BI.encode_gb(F.col("t")).alias("body"))
    cut = enc.select("page_id", F.when(F.col("page_id") == 2, F.substring("body", 1, 3)).otherwise(F.col("body")).alias("body"))
    got = {r["page_id"]: r["html"] for r in BI.decode_bodies(cut).collect()}
    assert got[1] == "简称人口"
    assert got[2].startswith("面") and got[2].endswith("�")


def test_observed_batch_counts(spark):
    from pageloom.operators.aggregates import count_by_key, observed
    df = spark.createDataFrame([("O",), ("F",), ("O",)], "s string")
    out, obs = observed(df, "batch")
    got = sorted(tuple(r) for r in count_by_key(out, ["s"]).collect())
    assert got == [("F", 1), ("O", 2)]
    assert obs.get["rows"] == 3


def test_stream_with_watermark(spark, tmp_path):
    from pageloom.streaming.stream_links import link_stream
    src = tmp_path / "in"
    pages = read_table(spark, SMOKE, "pages").select("page_id", "url", "html") \
        .withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    pages.coalesce(1).write.parquet(str(src))
    s = link_stream(spark, str(src), schema="page_id bigint, url string, html string, fetched_at timestamp",
                    event_time="fetched_at", delay="1 hour")
    q = s.writeStream.format("memory").queryName("wm_links").trigger(availableNow=True) \
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    got = spark.sql("SELECT url FROM wm_links")
    assert got.count() == got.distinct().count() > 0
