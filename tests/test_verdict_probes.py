"""Inputs that once gave wrong answers."""

from pyspark.sql import functions as F

from pageloom.functions.html import anchors
from pageloom.operators import tables as TB


def _anchors(spark, html):
    row = spark.createDataFrame([(html,)], "h string").select(anchors(F.col("h")).alias("a")).first()
    return [(r["href"], r["text"]) for r in row["a"]]


def test_links_in_any_quoting(spark):
    html = ("<a href=\"/o'brien\">A</a><a href=/unq>B</a><a data-href=\"/bad\" href='/good'>C</a>"
            "<a href = 'say \"hi\"'>D</a><a name=x>E</a><A HREF=\"/u\">F")
    assert _anchors(spark, html) == [("/o'brien", "A"), ("/unq", "B"), ("/good", "C"), ('say "hi"', "D"), ("", "E"), ("/u", "F")]


def test_a_megabyte_of_anchor_text(spark):
    text = "x" * (1 << 20)
    assert _anchors(spark, f'<a href="/long">{text}</a><a href="/next">n</a>') == [("/long", text), ("/next", "n")]


def test_repeated_change_keys(spark):
    old = spark.createDataFrame([("k", "a", "b")], "id string, x string, y string")
    new = spark.createDataFrame([("k", 2, None, "z"), ("k", 1, "c", "y"), ("n", 1, "p", None)],
                                "id string, at int, x string, y string")
    want = {("k", "c", "z"), ("n", "p", None)}
    assert {tuple(r) for r in TB.upsert(old, new, ["id"], order=["at"]).collect()} == want
    assert [tuple(r) for r in TB.keyed_update(old, new, ["id"], order=["at"]).collect()] == [("k", "c", "z")]
    two = spark.createDataFrame([("k", "b", "z"), ("k", "c", "y")], "id string, x string, y string")
    assert [tuple(r) for r in TB.keyed_update(old, two, ["id"]).collect()] == [("k", "b", "z")]


def test_paths_that_differ_only_in_control_characters(spark):
    from pageloom.operators.match import fuzzy_path_match
    left = spark.createDataFrame([(1, []), (2, [""]), (3, ["a\u0001b"]), (4, ["a", "b"]), (5, [None]), (6, ["", "x"])],
                                 "sid int, names array<string>")
    right = spark.createDataFrame([("c1", ["zzz"]), ("c2", ["a", "b"]), ("c3", ["q", ""]), ("c4", ["", ""])],
                                  "city_id string, names array<string>")
    got = {r["sid"]: r["city_id"] for r in fuzzy_path_match(left, right).collect()}
    assert got == {1: None, 2: "c1", 3: None, 4: "c2", 5: None, 6: "c3"}


def test_children_of_no_parent(spark):
    from pageloom.operators.hierarchy import children
    got = children(spark.createDataFrame([(1, None), (2, 1), (3, None)], "id int, pid int"))
    assert sorted((r["pid"] or 0, r["id"], r["n_children"]) for r in got.collect()) == [(0, 1, 2), (0, 3, 2), (1, 2, 1)]


def test_stream_reads_table_folders_and_keeps_the_first(spark, tmp_path):
    from pageloom.streaming.stream_links import LINKS_SCHEMA, run_link_intake
    page = '<nav><a href="/x">{}</a><a href="/{}">y</a></nav>'
    rows = [(i, "http://h.example.com/", page.format(f"text {i}", i)) for i in (3, 1, 2)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3).write.parquet(
        str(tmp_path / "pages.parquet"))
    folder = run_link_intake(spark, str(tmp_path), glob="pages.parquet")
    got = {r["url"]: (r["parent_id"], r["anchor_text"]) for r in spark.read.schema(LINKS_SCHEMA).parquet(folder).collect()}
    assert got == {"http://h.example.com/x": (1, "text 1"), "http://h.example.com/1": (1, "y"),
                   "http://h.example.com/2": (2, "y"), "http://h.example.com/3": (3, "y")}
