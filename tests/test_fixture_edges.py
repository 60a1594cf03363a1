"""Edge inputs named in FIXTURES.md that the generated tables do not hold."""

from pyspark.sql import functions as F

from pageloom.operators import binary as BI
from pageloom.operators import extract as EX


def _pages(spark, *htmls, url="http://Host.example.com:8080/x/page"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")


def test_filter_page_links(spark):
    html = ('<nav><a href="/Sub/A">A</a><a href="/empty"></a><a href="">no url</a>'
            '<a href="HTTP://Other.example.org/Z">Z</a><a href="https://s.example.net/Q">Q</a></nav>')
    got = [(r["anchor_text"], r["url"]) for r in EX.page_links(_pages(spark, html)).orderBy("pos").collect()]
    assert got == [("A", "http://Host.example.com:8080/sub/a"), ("Z", "http://other.example.org/z"),
                   ("Q", "https://s.example.net/q")]


def test_stored_fragment_links(spark):
    rows = spark.createDataFrame(
        [(1, "http://h.example.com/p", '<a href="a/b">bare</a><a href="/a/b">rooted</a>'
                                       '<a href="http://x.example.org/c">abs</a><a href="/t"></a>', "")],
        "id bigint, url string, subway string, district string")
    got = [(r["anchor_text"], r["url"]) for r in EX.fragment_links(rows).orderBy("pos").collect()]
    assert got == [("bare", "http://h.example.com/a/b"), ("rooted", "http://h.example.com/a/b"),
                   ("abs", "http://x.example.org/c")]


def test_list_item_without_link_is_skipped(spark):
    html = "<ul><li><a href='/1'> one </a></li><li>no link</li><li><b>x</b><a href='/3'>three</a></li></ul>"
    got = [(r["pos"], r["item"]) for r in EX.list_items(_pages(spark, html)).orderBy("pos").collect()]
    assert got == [(1, "one"), (3, "three")]


def test_image_length_boundary(spark):
    jpeg = bytes.fromhex("FFD8FF")
    bodies = spark.createDataFrame([(1, jpeg + b"x" * 17), (2, jpeg + b"x" * 18), (3, b"<html>" + b"y" * 30),
                                    (4, bytes.fromhex("89504E470D0A1A0A") + b"z" * 20),
                                    (5, b"GIF87a" + b"g" * 20), (6, b"RIFF\x00\x00\x00\x00WEBP" + b"w" * 10)],
                                   "page_id bigint, body binary")
    got = {r["page_id"]: (r["kind"], r["n_bytes"]) for r in BI.image_signature(bodies).collect()}
    assert got == {2: ("jpeg", 21), 4: ("png", 28), 5: ("gif", 26), 6: ("webp", 22)}
    assert F is not None


def test_url_derived_keys_on_catalogue_shapes(spark):
    from pageloom.operators import derive as DV
    rows = spark.createDataFrame([
        (1, "http://www.example.com/Lisbon-tours/River-Boats-and-Bridges/d781-g9"),
        (2, "/Oslo-attractions/d652-ttd"),
        (3, "/Quito/d118-ttd"),
        (4, "/Turin-attractions/no-number")], "page_id bigint, url string")
    got = {r["page_id"]: (r["dgroup"], r["dgroupid"], r["destination"], r["destinationid"]) for r in
           DV.url_derived_keys(rows, group_re=r"-g(\d+)", dest_re=r"d(\d+)").collect()}
    assert got[1] == ("River-Boats-and-Bridges", "g9", "Lisbon-tours", "781")
    assert got[2] == ("Oslo-attractions", None, "Oslo", "652")
    assert got[3] == ("Quito", None, "Quito", "118")
    assert got[4] == ("Turin-attractions", None, "Turin", "0")


def test_bad_url_shape_suffix(spark):
    from pageloom.operators import derive as DV
    rows = spark.createDataFrame([(1, "http://www.example.com/Lisbon-tours/x/d1-g2"),
                                  (2, "http://www.example.com/Oslo/d3-g4")], "page_id bigint, url string")
    assert [(r["page_id"], r["tok"]) for r in DV.bad_url_shape(rows, "-tours").collect()] == [(2, "Oslo")]
