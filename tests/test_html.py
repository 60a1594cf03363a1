"""The balanced element cutter and the attribute scanner: once wrong answers,
odd markup, and random nesting against a tree from the standard library."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from pageloom.functions import html as H
from pageloom.functions.text import html_unescape
from pageloom.operators import cards as CA
from pageloom.operators import extract as EX
from pageloom.operators import ids as ID


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r["r"] for r in df.select("i", fn(F.col("s")).alias("r")).orderBy("i").collect()]


def _pages(spark, *htmls, **columns):
    rows = [(i, "http://h.example.com/p", h, *columns.values()) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string" + "".join(f", {c} bigint" for c in columns))


def test_links_are_read_by_the_rules_of_tags(spark):
    html = ('<a title="x href=/bad" href="/good">t</a><a title="a>b" href=/g2>t2</a><a-x href="/no">n</a>'
            "<a href='q\"r'>z<!-- <a href=1>no</a> --><A\nHREF=/u ><b>bold</b>tail</A><a href>none</a><a data-href=/x href = /y>y</a>"
            "<script>'<a href=/s>s</a>'</script><a href=/1 href=/2>first</a>")
    got = _eval(spark, [html], H.anchors)[0]
    assert [(a["href"], a["text"]) for a in got] == [
        ("/good", "t"), ("/g2", "t2"), ('q"r', "z"), ("/u", "tail"), ("", "none"), ("/y", "y"), ("/1", "first")]


def test_entities(spark):
    texts = {"&eacute;&nbsp;&#38;&#x4E2D;&#X1f642;": "é &中\U0001f642", "&bogus; & &; &#; &#x;": "&bogus; & &; &#; &#x;",
             "&amp;lt;": "&lt;", "&#150;&#0;&#55296;&#1114112;": "–���", "plain": "plain", "": "", "&apos;&quot;": "'\""}
    assert _eval(spark, list(texts), html_unescape) == list(texts.values())


BLOCKS = [
    ('<div class="ad"><div>in</div>tail</div><div class="b">x</div>', '<div class="ad"><div>in</div>tail</div>'),
    ("<p>x</p><div id=1 class='ab'>y<DIV>z</DIV></div >w", "<div id=1 class='ab'>y<DIV>z</DIV></div >"),
    ('<div title=\'class="ad"\'>no</div><div class="ad">open<div>', '<div class="ad">open<div>'),
    ('<!-- <div class="ad">c</div> --><div class="ad">x<!-- </div> --></div>', '<div class="ad">x<!-- </div> --></div>'),
    ('<div class="ad"><script>"</div>"</script>y</div>z', '<div class="ad"><script>"</div>"</script>y</div>'),
    ("</div><divx class=a></divx>", ""), ("", ""), (None, None), ('<div class="ba">', ""),
]


def test_blocks(spark):
    got = _eval(spark, [b for b, _ in BLOCKS], lambda c: H.block(c, "div", "class", "a", prefix=True))
    assert got == [w for _, w in BLOCKS]
    any_tag = ["<x><span id=q class=\"subway2\">a<span>b</span>c</span></x>", "<p class=subw>x<p class=subway>y</p>z", "none"]
    assert _eval(spark, any_tag, lambda c: H.block(c, "*", "class", "subway", prefix=True)) == [
        '<span id=q class="subway2">a<span>b</span>c</span>', "<p class=subway>y</p>", ""]
    assert _eval(spark, ['<div id=a><div>x</div></div>'], lambda c: H.block(c, "div", "id", "a", inner=True)) == ["<div>x</div>"]


def test_end_tags_may_be_left_out(spark):
    assert _eval(spark, ["<ul><li>a<ul><li>b</ul><li>c</ul>d<li>e"], lambda c: H.elements(c, H.Element("li"))) == [
        ["<li>a<ul><li>b</ul>", "<li>b", "<li>c", "<li>e"]]
    rows = _eval(spark, ["<tr><td>1<td>2<tr><td><table><tr><td>i</table><td>3</tr>"], lambda c: F.transform(
        H.elements(c, H.Element("tr"), level=0), lambda r: H.elements(r, H.Element("td"), level=0)))
    assert rows == [[["<td>1", "<td>2"], ["<td><table><tr><td>i</table>", "<td>3"]]]
    assert _eval(spark, ["a<p>one<b>x</b></p>mid<p>two<p>three<br>y</p> < z"], lambda c: H.children(c, "p")) == [
        ["<p>one<b>x</b></p>", "<p>two", "<p>three<br>y</p>"]]
    assert _eval(spark, ["a<p>one</p>m<br>i<i>q</i>d < z<img/>"], H.direct_texts) == [["a", "m", "i", "d < z"]]


class _Tree(HTMLParser):
    """Outer texts of all elements of one tag, by start; nesting by the same tag."""

    def __init__(self, html, tag):
        super().__init__(convert_charrefs=False)
        self.html, self.tag, self.open, self.found = html, tag, [], []
        self.feed(html)
        self.close()
        self.found += [(at, len(html)) for at in self.open]

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.open.append(self.getpos()[1])

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            at = self.getpos()[1]
            self.found.append((self.open.pop(), self.html.index(">", at) + 1))


def test_random_nesting_equals_a_parser(spark):
    rng = random.Random(4)
    parts = ["<div>", "<div class='a b' title=\"x>y\">", "</div>", "</DIV >", "<p>", "</p>", "text", " < ", "<span id=1>", "</span>", "<br/>",
             "<!-- <div> -->", "&amp;", "<div data-x='</div>'>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    got = _eval(spark, pages, lambda c: H.elements(c, H.Element("div")))
    for page, found in zip(pages, got, strict=True):
        assert found == [page[a:b] for a, b in sorted(_Tree(page, "div").found)], page
    first = _eval(spark, pages, lambda c: H.block(c, "div"))
    assert first == [f[0] if f else "" for f in got]


@pytest.mark.parametrize("html", ["<div " * 20000, "<" * 50000, '<a href="' * 20000, "<!--" * 20000, "<div>" * 500, "<div " + '""' * 50000 + ">x</div>",
                                  "<a>" + "x<br>" * 5000])
def test_odd_long_pages(spark, html):
    assert _eval(spark, [html], lambda c: F.length(H.block(c, "div"))) != [None]
    assert _eval(spark, [html], lambda c: F.size(H.anchors(c))) != [None]


def test_all_listing_tables(spark):
    table = '<table width="738" bgcolor=cccccc>{}</table>'
    row = '<tr><td><strong><a tppabs="/{0}" href=#>{0}</a></strong></td><td>x</td></tr>'
    inner = "<tr><td><table><tr><td><strong><a>no</a></strong></td></tr></table></td></tr>"
    page = table.format("<tr><td>head</td></tr>" + row.format("a") + inner) + "<p>" + table.format(row.format("b") + row.format("c"))
    got = [(r["pos"], r["anchor_text"], r["url"]) for r in CA.table_rows(_pages(spark, page)).orderBy("pos").collect()]
    assert got == [(1, "a", "/a"), (2, "no", ""), (3, "b", "/b"), (4, "c", "/c")]


def test_all_boxes_and_texts_of_a_sub_page(spark):
    box = '<table bgcolor="cccccc" width="432px"><tr><td><strong>{}</strong>:{}</td></tr></table>'
    page = "<h1>t</h1>" + box.format("面积", "1") + '<div class="f14">a<div>no</div>b</div>' + box.format("人口", "2") + "<div class=f14>c</div>"
    row = CA.sub_info(spark, _pages(spark, page)).first()
    assert (row["area"], row["population"], row["description"], row["f12"]) == ("1", "2", "a\nb\nc", "")
    both = CA.page_kind_branch(spark, _pages(spark, page, pid=1)).first()
    assert (both["area"], both["population"], both["address"]) == ("1", "2", None)


def test_cards_end_with_their_element(spark):
    card = ('<div class="media product-summary mhn mtn"><div class="img product-image mrl"><a href="/{0}">i</a></div><h2><a href="#">{0}</a></h2>'
            '<p class="man mts">d{0}</p><div class="product-price txtR">{0}</div></div>')
    page = card.format("1") + card.format("2") + '<footer><div class="product-price txtR">promo</div><p class="man mts">foot</p></footer>'
    got = [(r["href"], r["title"], r["description"], r["price"]) for r in CA.product_cards(_pages(spark, page)).orderBy("pos").collect()]
    assert got == [("/1", "1", "d1", "1"), ("/2", "2", "d2", "2")]


def test_best_description_stays_in_its_block(spark):
    marks = 'x<div class="content_h2 bac_no">m</div>OUTside<div class="content_h2">'
    long_text = "word " * 30
    pages = ['<div id="content"><p>short</p></div>' + marks, f'<div id="content"><h2>h</h2>t<p>{long_text}</p><p>no</p></div>',
             f'<div id="content"><div><p>{long_text}</p></div>a{marks}z</div></div>', "<p>none</p>", None,
             '<div id="unifyprompt"><b>x</b><div><i>y</i><p>abs<b>tract</b></p></div></div>']
    got = [r["description"] for r in CA.best_description(_pages(spark, *pages)).orderBy("page_id").collect()]
    assert got == ["", long_text, "m</div>OUTside".replace("</div>", ""), "", "", "abstract"]


def test_blocks_by_selectors(spark):
    page = '<dl id="filter_quyu" class="x"><dl>in</dl></dl><b class="subwayline3">s</b><div class=tosq>q</div>'
    wanted = {"area": H.Element("dl", (("class", "x"), ("id", "filter_quyu"))), "subway": H.Element("*", (("class^", "subwayline"),)),
              "district": H.Element("div", (("class", "tosq"),))}
    row = EX.html_blocks(_pages(spark, page), wanted).first()
    assert (row["area"], row["subway"], row["district"]) == (
        '<dl id="filter_quyu" class="x"><dl>in</dl></dl>', '<b class="subwayline3">s</b>', "<div class=tosq>q</div>")


def test_groups_are_stored_once_and_numbered_on(spark):
    item = '<li><a href="/g{0}">G{0}</a><ul><li><a href=/s{0}>S</a><li><a href="http://x/">abs</a></ul>'
    page = '<div class="bd"><div><ul><li><a href=/deep>d</a></ul></div><ul>' + item.format(1) + item.format(2) + '<li><a href="/a-ttd">t</a></ul><ul><li><a href=/n>n</a></ul></div>'
    links = CA.nested_list_links(_pages(spark, page, page), "http://s")
    stored = spark.createDataFrame([("http://s/g2", "old", 7, None)], "href string, anchor_text string, id bigint, pid bigint")
    first = ID.store_groups(links, stored)
    want = [("http://s/g1", "G1", 8, None), ("http://s/s1", "S", 9, 8), ("http://s/s2", "S", 10, 7)]
    assert sorted(map(tuple, first.collect())) == want
    assert sorted(map(tuple, ID.store_groups(links, stored).collect())) == want
    assert ID.store_groups(links, stored.unionByName(first)).count() == 0


def test_new_pager_links(spark):
    pager = '<p class="txtR mhn mbl"><a href="/l/{0}">2</a><a href="/l/3">3</a></p><p class="txtR mhn mbl"><a href="/no">n</a></p>'
    pages = _pages(spark, pager.format(1), pager.format(2), pager.format(9))
    stored = spark.createDataFrame([("http://s/l/2",)], "href string")
    got = CA.new_pager_links(pages, stored, "http://s", F.col("page_id") < 2)
    assert sorted(map(tuple, got.collect())) == [("http://s/l/1", 0), ("http://s/l/3", 0)]
