"""Properties from the test strategy: a frontier round run twice adds
nothing, whitespace collapsing is idempotent, absolute links are dropped by
the list builder, stream results equal batch results."""

from pyspark.sql import functions as F

from conftest import SMOKE
from pageloom.functions import text as TX
from pageloom.operators import extract as EX
from pageloom.operators import frontier as FR
from pageloom.sources.tables import read_table


def test_frontier_twice_adds_nothing(spark):
    pages = read_table(spark, SMOKE, "pages").select("page_id", "url", "html")
    first = FR.crawl_frontier(pages, pages.select("url"))
    assert first.count() > 0
    known = pages.select("url").unionByName(first.select("url"))
    assert FR.crawl_frontier(pages, known).count() == 0


def test_frontier_urls_unique_and_absolute(spark):
    pages = read_table(spark, SMOKE, "pages").select("page_id", "url", "html")
    out = FR.crawl_frontier(pages, pages.select("url"))
    assert out.count() == out.select("url").distinct().count()
    assert out.where(~F.col("url").rlike(r"\Ahttps?://")).count() == 0
    assert out.where(F.col("url") != F.lower("url")).count() == 0


def test_collapse_ws_idempotent(spark):
    docs = read_table(spark, SMOKE, "documents").select("doc_id", TX.collapse_ws("text").alias("c"))
    again = docs.select("doc_id", "c", TX.collapse_ws("c").alias("c2"))
    assert again.where(F.col("c") != F.col("c2")).count() == 0


def test_site_links_drop_absolute(spark):
    html = '<nav><a href="/a">A</a><a href="http://x.org/b">B</a><a href=" /c ">C</a></nav>'
    pages = spark.createDataFrame([(1, "http://h.com/", html)], "page_id bigint, url string, html string")
    got = [(r["anchor_text"], r["href"]) for r in EX.site_links(pages, "http://site").orderBy("pos").collect()]
    assert got == [("A", "http://site/a"), ("C", "http://site/c")]


def test_stream_equals_batch(spark):
    from pageloom.streaming.stream_links import run_link_intake
    table = run_link_intake(spark, SMOKE, glob="pages.parquet")
    streamed = {r["url"] for r in spark.read.parquet(table).select("url").collect()}
    pages = read_table(spark, SMOKE, "pages").select("page_id", "url", "html")
    batch = {r["url"] for r in FR.first_link_occurrence(EX.page_links(pages)).select("url").collect()}
    assert streamed == batch
    # a restart on the same checkpoint and table adds nothing
    import uuid
    name = f"restart-{uuid.uuid4().hex}"
    t1 = run_link_intake(spark, SMOKE, glob="pages.parquet", name=name)
    n1 = spark.read.parquet(t1).count()
    t2 = run_link_intake(spark, SMOKE, glob="pages.parquet", name=name)
    assert t1 == t2 and spark.read.parquet(t2).count() == n1 == len(batch)


def test_stream_across_micro_batches(spark, tmp_path):
    """Page files arrive one per micro-batch; URLs repeated across files are
    stored once and the table equals the batch first-occurrence key set."""
    from pageloom.streaming.stream_links import run_link_intake
    pages = read_table(spark, SMOKE, "pages").select("page_id", "url", "html")
    src = tmp_path / "arrivals"
    # three arrival files; every page appears in two of them
    for i, (lo, hi) in enumerate([(0, 20), (10, 40), (30, 10**9)]):
        pages.where((F.col("page_id") >= lo) & (F.col("page_id") < hi)).coalesce(1) \
            .write.parquet(str(src / f"part{i}"))
        for f in (src / f"part{i}").glob("*.parquet"):
            f.rename(src / f"arrival{i}.parquet")
    table = run_link_intake(spark, str(src), glob="arrival*.parquet", files_per_batch=1)
    stored = spark.read.parquet(table)
    batch = {r["url"] for r in FR.first_link_occurrence(EX.page_links(pages)).select("url").collect()}
    assert stored.count() == len(batch)
    assert {r["url"] for r in stored.select("url").collect()} == batch
    assert stored.select("epoch").distinct().count() == 3


def test_hierarchy_star_tree_hot_root(spark):
    """A root holding most of the nodes (the hot ancestor every round joins
    to) still yields exact paths."""
    from pageloom.operators import hierarchy as HI
    n = 5000
    rows = [(1, 0)] + [(i, 1) for i in range(2, n)] + [(n + i, i) for i in range(2, 50)]
    df = spark.createDataFrame(rows, "id bigint, pid bigint")
    got = {r["id"]: (r["path"], r["level"]) for r in HI.hierarchy_paths(df).collect()}
    assert got[1] == ("1", 1) and got[4999] == ("1|4999", 2) and got[n + 7] == (f"1|7|{n + 7}", 3)
    assert len(got) == len(rows)
