"""Late fetch by place, and the content-addressed store."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pageloom.operators import content as CO
from pageloom.operators import derive as DV
from pageloom.operators.tables import append
from pageloom.sources import locator

JPEG = bytes.fromhex("FFD8FF")


@pytest.fixture(scope="module")
def crawl(spark, tmp_path_factory):
    """Page files of many small row groups, in a folder with a space and a
    percent sign in its name."""
    folder = tmp_path_factory.mktemp("late") / "a b%20c"
    folder.mkdir()
    rnd = random.Random(2)
    rows = [(f"http://h/{i}", None if i % 17 == 0 else f"<a href=t{i % 50}>" + "é" * rnd.randint(0, 300), 404 if i % 11 == 0 else 200)
            for i in range(700)]
    for at, group in ((0, 7), (250, 100), (500, 1000)):
        part = rows[at:at + 250]
        pq.write_table(pa.table({"url": [r[0] for r in part], "html": [r[1] for r in part], "status": [r[2] for r in part]}),
                       folder / f"{at}.parquet", row_group_size=group)
    return spark.read.parquet(str(folder)), rows


def test_fetch_gives_the_rows_that_were_named(crawl, monkeypatch):
    pages, rows = crawl
    monkeypatch.setattr(locator, "HANDED_ON", 500)
    at = locator.located(pages, "url").where(F.substring("url", -1, 1).isin("0", "3", "7"))
    twice = append(at.withColumn("n", F.lit(1)), at.withColumn("n", F.lit(2)))
    got = sorted((r["url"], r["n"], r["html"] or "") for r in locator.fetch(twice, pages, "html").collect())
    assert got == sorted((u, n, h or "") for u, h, _ in rows if u[-1] in "037" for n in (1, 2))
    assert locator.fetch(at.where("false"), pages, "html").count() == 0
    monkeypatch.setattr(locator, "READABLE", set())  # a store that only Spark reads
    assert sorted((r["url"], r["n"], r["html"] or "") for r in locator.fetch(twice, pages, "html").collect()) == got


def test_backlinks_move_no_bodies(spark, crawl):
    pages, rows = crawl
    pairs = spark.createDataFrame([(i, f"h/{i % 900}", f"t{i % 100}>" if i % 41 else None) for i in range(1800)],
                                  "id int, inboundfrom string, inboundto string")
    out = DV.backlink_check(pairs, pages)
    want = []
    for i in range(1800):
        if i % 900 < 700:
            _, html, status = rows[i % 900]
            held = html is not None and i % 41 != 0 and f"t{i % 100}>" in html
            want.append((i, f"status:{status}" if status != 200 else "matched" if held else "missed"))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "FileScan" in line:
            assert "html" not in line.split("ReadSchema")[1]
        if "MapInPandas" not in line and "Exchange" in line:
            assert "html" not in line


def test_a_hot_page_is_shared_out(spark, crawl):
    """Requests that name one row come to several tasks."""
    pages, _ = crawl
    one = locator.located(pages.where("url = 'http://h/5'"))
    many = one.crossJoin(spark.range(4000))
    read = locator.fetch(many, pages, "html").select("id", F.spark_partition_id().alias("task"))
    sizes = [r["count"] for r in read.groupBy("task").count().collect()]
    assert sum(sizes) == 4000
    assert "rangepartitioning(file" in read._jdf.queryExecution().executedPlan().toString()


def test_store_holds_each_content_once_and_reruns_add_nothing(spark, tmp_path):
    big = JPEG + b"x" * 40
    rows = [("http://a", big), ("http://b", big), ("http://c", JPEG + b"y" * 30), ("http://d", JPEG), ("http://e", b"<html>" * 9),
            ("http://f", None), ("http://c", JPEG + b"z" * 30), ("http://g", big)]
    spark.createDataFrame(rows, "url string, body binary").repartition(3).write.parquet(str(tmp_path / "bodies"))
    bodies = spark.read.parquet(str(tmp_path / "bodies"))
    tours = spark.createDataFrame([("http://a", 0), ("http://a", 0), ("http://b", None), ("http://c", 0), ("http://d", 0), ("http://e", 0),
                                   ("http://f", -1), ("https://a", 0), ("http://g", 4), ("http://none", 0), (None, 0)],
                                  "head_image string, image_id int")
    root = str(tmp_path / "store")
    urls = CO.wanted_images(tours)
    assert sorted(r[0] for r in urls.collect()) == [f"http://{c}" for c in ("a", "c", "d", "e", "f", "none")]
    for _ in range(2):
        CO.store_images(urls, bodies, root, "page")
        index, content = CO.open_store(spark, root)
        assert (index.count(), content.count()) == (2, 2)
    CO.store_images(spark.createDataFrame([("http://b",), ("http://a",)], "source_url string"), bodies, root, "late")
    index, content = CO.open_store(spark, root)
    assert (index.count(), content.count()) == (3, 2)  # the bytes of b were there
    back = {r["source_url"]: (r["category"], r["n_bytes"]) for r in CO.read_back(spark, root).collect()}
    assert back == {"http://a": ("page", 43), "http://b": ("late", 43), "http://c": ("page", 33)}
    signed = {r["source_url"]: r["md5"] for r in CO.read_back(spark, root).collect()}
    assert signed == {r["source_url"]: r["md5"] for r in index.collect()}
