"""Rendered page fixtures, built by Spark from the given tables.

The crawled ``pages`` table has no info boxes, listing tables or product
cards, so pages of those kinds are rendered from ``nation``, ``customer``,
``part`` and ``documents`` rows with ``format_string``/``concat``.  The
extraction jobs run on them, and the DuckDB oracle reads the expected
values straight from the source columns (a round trip).  A page groups at
most ten rows (``key div 10``) or the fixed 25-row nation table, so no
rendering step gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.urls import url_quote
from pageloom.sources.tables import dealt, read_table

WIKI = "http://wiki.example.org/wiki/"
GEO_SITE = "http://geo.example.org/"


def _concat_rows(df: DataFrame, key: str, order: str, html: str) -> DataFrame:
    """Rows of one page in order, concatenated (groups are bounded)."""
    return (df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, html))).alias("_r"))
            .select(key, F.array_join(F.transform("_r", lambda r: r[html]), "").alias("rows")))


def nation_table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One listing page per region: header row, a row per nation with a bold
    link carrying a second URL attribute, and a closing row without link."""
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    row = F.format_string('<tr><td><strong><a href="/n%d.html" tppabs="%s%s.html">%s</a></strong></td><td>%d</td></tr>',
                          "n_nationkey", F.lit(GEO_SITE), "n_name", "n_name", "n_nationkey")
    rows = _concat_rows(n.select("n_regionkey", "n_nationkey", row.alias("h")), "n_regionkey", "n_nationkey", "h")
    counts = n.groupBy(F.col("n_regionkey").alias("c_rk")).agg(F.count(F.lit(1)).alias("cnt"))
    page = F.concat(F.lit("<html><body><h1>"), F.col("r_name"), F.lit('</h1><table bgcolor="cccccc" width="738">'),
                    F.lit("<tr><td>name</td><td>key</td></tr>"), F.coalesce("rows", F.lit("")),
                    F.format_string("<tr><td>total</td><td>%d</td></tr>", F.coalesce("cnt", F.lit(0))),
                    F.lit("</table></body></html>"))
    return (r.join(rows, r["r_regionkey"] == rows["n_regionkey"], "left")
            .join(counts, r["r_regionkey"] == counts["c_rk"], "left")
            .select(F.col("r_regionkey").cast("bigint").alias("page_id"), page.alias("html")))


def province_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _province_pages(dealt(read_table(spark, sf, "customer")))


def _province_pages(c: DataFrame) -> DataFrame:
    cells = F.concat(
        F.format_string("<tr><td><strong>简称</strong>:%s</td>", "c_mktsegment"),
        F.format_string('<td><strong>面积</strong><a href="#a">%.2f</a></td></tr>', "c_acctbal"),
        F.format_string("<tr><td><strong>人口</strong>: %d</td><td><strong>备注</strong>:x</td></tr>", "c_nationkey"),
        F.format_string("<tr><td><strong>所在地址</strong>: Street %d</td>", "c_custkey"),
        F.format_string("<td><strong>辖区面积</strong>:%.1f</td></tr>", F.col("c_acctbal") * 2),
        F.lit("<tr><td><strong>地址</strong>:skipped</td><td><strong>邮政编码</strong></td></tr>"))
    html = F.concat(F.format_string("<html><body><h1> %s </h1>", "c_name"),
                    F.lit('<div id="page_left"><table><tr><td>menu</td></tr></table><table><tr><td><table>'),
                    cells,
                    F.format_string("</table></td><td>%s line<br>%s line</td></tr></table></div></body></html>",
                                    "c_name", "c_mktsegment"))
    return c.select(F.col("c_custkey").alias("page_id"), F.lit(0).cast("bigint").alias("pid"), html.alias("html"))


def sub_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _sub_pages(dealt(read_table(spark, sf, "customer")))


def _sub_pages(c: DataFrame) -> DataFrame:
    cells = F.concat(
        F.format_string("<tr><td><strong>人口</strong>: %d<br>万</td>", "c_nationkey"),
        F.format_string("<td><strong>行政代码</strong>%d</td></tr>", "c_custkey"),
        F.lit("<tr><td><strong>面积</strong></td><td><strong>未知</strong>1</td></tr>"))
    seg = F.col("c_mktsegment")
    t432 = F.concat(F.lit('<table width="432px" bgcolor="cccccc">'), cells, F.lit("</table>"))
    t396 = F.concat(F.lit('<table width="396px" bgcolor="cccccc">'), cells, F.lit("</table>"))
    box = (F.when(seg.isin("BUILDING", "AUTOMOBILE"), t432)
           .when(seg.isin("MACHINERY", "HOUSEHOLD"), t396)
           .otherwise(F.concat(F.lit('<table width="432px" bgcolor="cccccc"></table>'), t396)))
    html = F.concat(F.format_string("<html><body><h1>%s</h1><div id=\"page_left\">", "c_name"), box,
                    F.format_string('<div class="f14">%s f14<br>second</div><div class="f12">%s f12</div>',
                                    "c_name", "c_mktsegment"),
                    F.lit("</div></body></html>"))
    return c.select(F.col("c_custkey").alias("page_id"), (F.col("c_nationkey") + 1).cast("bigint").alias("pid"),
                    html.alias("html"))


def mixed_place_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Province pages (pid 0) for BUILDING customers, sub pages otherwise."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")

    def of(segment) -> DataFrame:
        # the rows are joined and dealt out before they grow to pages
        keys = c.where(segment).select(F.col("c_custkey").alias("key"))
        return dealt(c.join(keys, F.col("c_custkey") == F.col("key"), "left_semi"))
    building = F.col("c_mktsegment") == "BUILDING"
    return _province_pages(of(building)).unionByName(_sub_pages(of(~building)))


def _bucket(col="p_partkey"):
    return (F.col(col) / 10).cast("bigint")


def price_table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Title/price tables, ten parts per page; PROMO rows lack the title,
    SMALL rows lack the price."""
    p = read_table(spark, sf, "part")
    title = F.when(F.col("p_type") == "PROMO", F.format_string("<td>%s</td>", "p_name")) \
        .otherwise(F.format_string('<td><h3><a href="#">%s</a></h3></td>', "p_name"))
    price = F.when(F.col("p_type") == "SMALL", F.lit("<td>n/a</td>")) \
        .otherwise(F.format_string("<td><p><span><span><span>%.2f</span></span></span></p></td>", "p_retailprice"))
    row = F.concat(F.lit("<tr>"), title, F.format_string("<td>%s</td>", "p_brand"), price, F.lit("</tr>"))
    rows = _concat_rows(p.select(_bucket().alias("page_id"), "p_partkey", row.alias("h")), "page_id", "p_partkey", "h")
    return rows.select("page_id", F.concat(F.lit("<html><body><table><tbody>"), "rows",
                                           F.lit("</tbody></table></body></html>")).alias("html"))


def attraction_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Two card layouts.  ECONOMY/STANDARD parts give layout-A pages that
    also carry layout-B cards (A wins), SMALL/MEDIUM parts give B-only
    pages, PROMO/LARGE parts give pages without cards.  Every page has two
    pagers; only the first counts."""
    p = read_table(spark, sf, "part")
    kind = (F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "A")
            .when(F.col("p_type").isin("SMALL", "MEDIUM"), "B").otherwise("N"))
    a_card = F.format_string('<div class="ttd-row-height"><div class="product-image"><a href="/a/%d">img</a></div>'
                             '<h2><a href="/a/%d">%s</a></h2><p class="man mts">%s\n%s</p></div>',
                             "p_partkey", "p_partkey", "p_name", "p_type", "p_brand")
    b_card = F.format_string('<div class="media product-summary mtn mhn"><div class="img mrl prs"><a href="/b/%d">i</a>'
                             '</div><h2><a href="#">%s</a></h2><p class="man mts">%s</p></div>',
                             "p_partkey", F.when(kind == "A", F.concat(F.lit("B "), "p_name")).otherwise(F.col("p_name")),
                             "p_brand")
    parts = p.select(kind.alias("kind"), _bucket().alias("b"), "p_partkey", a_card.alias("a"), b_card.alias("bc"))
    keyed = parts.withColumn("g", F.concat_ws(":", "kind", F.col("b").cast("string")))
    a_rows = _concat_rows(keyed.where(F.col("kind") == "A"), "g", "p_partkey", "a")
    b_rows = _concat_rows(keyed.where(F.col("kind") != "N"), "g", "p_partkey", "bc").withColumnRenamed("rows", "brows")
    pid = keyed.groupBy("g").agg(F.min("p_partkey").alias("page_id"))
    pages = pid.join(a_rows, "g", "left").join(b_rows, "g", "left")
    html = F.concat(F.lit("<html><body>"),
                    F.when(F.col("rows").isNotNull(), F.concat(F.lit('<div class="unit size1of3">'), "rows",
                                                                F.lit("</div>"))).otherwise(F.lit("")),
                    F.coalesce("brows", F.lit("")),
                    F.format_string('<p class="txtR mhn mbl"><a href="/list/%d-2">2</a> <a href="/list/%d-3">3</a></p>',
                                    "page_id", "page_id"),
                    F.format_string('<p class="txtR mhn mbl"><a href="/other/%d">x</a></p>', "page_id"),
                    F.lit("</body></html>"))
    return pages.select(F.col("page_id").cast("bigint"), html.alias("html"))


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Product cards, ten parts per page, PROMO parts without a card; two
    price blocks per card with markup and line breaks."""
    p = read_table(spark, sf, "part")
    card = F.format_string(
        '<div class="media product-summary mhn mtn"><div class="img product-image mrl"><a href="/t/%d">i</a></div>'
        '<h2><a href="/t/%d">%s</a></h2><p class="man mts">%s\n</p><p class="man mts note xsmall"> %s </p>'
        '<div class="product-price txtR"><span>USD</span>\n<b>%.2f</b></div>'
        '<div class="product-price txtR">from<br>\n   %d</div></div>',
        "p_partkey", "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice", "p_size")
    card = F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(card)
    rows = _concat_rows(p.select(_bucket().alias("page_id"), "p_partkey", card.alias("h")), "page_id", "p_partkey", "h")
    return rows.select("page_id", F.concat(F.lit("<html><body>"), "rows", F.lit("</body></html>")).alias("html"))


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Encyclopedia pages from documents, one per document, URL from its
    name.  en: abstract (empty for source src0); fr: placeholder abstract,
    content with the text as first paragraph and a heading section; es: no
    abstract, short first paragraph, the text in the heading section; other
    languages: neither."""
    d = read_table(spark, sf, "documents")
    section = F.concat(F.lit('<div class="content_h2 bac_no">'), F.col("source"), F.lit("</div>"), F.col("text"),
                       F.lit('<div class="content_h2">end</div>'))
    en = F.concat(F.lit('<div id="unifyprompt"><div><p>'),
                  F.when(F.col("source") == "src0", F.lit("")).otherwise(F.col("text")),
                  F.lit('</p></div></div><div id="content"><p>x</p></div>'))
    fr = F.concat(F.lit('<div id="unifyprompt"><div><p>添加摘要 '), F.col("source"),
                  F.lit('</p></div></div><div id="content"><p>'), F.col("text"), F.lit("</p>"), section,
                  F.lit("</div>"))
    es = F.concat(F.lit('<div id="content"><p>'), F.col("source"), F.lit("</p>"), section, F.lit("</div>"))
    body = (F.when(F.col("lang") == "en", en).when(F.col("lang") == "fr", fr).when(F.col("lang") == "es", es)
            .otherwise(F.lit("<div>no article</div>")))
    return d.select(F.col("doc_id").alias("page_id"),
                    F.concat(F.lit(WIKI), url_quote(F.concat(F.lit("doc "), F.col("doc_id").cast("string")))).alias("url"),
                    F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def region_list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per region with a nested list: a group link per nation with
    a sub-list of two links, an absolute link (dropped), a link ending in
    'ttd' (skipped), and a second list that is not read."""
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    item = F.format_string(
        '<li><a href="/%s-tours/d%d-g%d">%s</a><ul><li><a href="/%s-tours/day/d%d-g1">%s day</a></li>'
        '<li><a href="/%s-tours/night/d%d-g2">%s night</a></li></ul></li>',
        "n_name", "n_regionkey", "n_nationkey", "n_name", "n_name", "n_nationkey", "n_name", "n_name",
        "n_nationkey", "n_name")
    rows = _concat_rows(n.select("n_regionkey", "n_nationkey", item.alias("h")), "n_regionkey", "n_nationkey", "h")
    html = F.concat(
        F.lit('<html><body><div class="bd"><ul>'), F.coalesce("rows", F.lit("")),
        F.format_string('<li><a href="http://other.example.net/%s">ext</a></li>', "r_name"),
        F.format_string('<li><a href="/%s/d%d-ttd">%s ttd</a></li>', "r_name", "r_regionkey", "r_name"),
        F.lit("</ul><ul>"), F.format_string('<li><a href="/second/%d">second</a></li>', "r_regionkey"),
        F.lit("</ul></div></body></html>"))
    return (r.join(rows, r["r_regionkey"] == rows["n_regionkey"], "left")
            .select(F.col("r_regionkey").cast("bigint").alias("page_id"), html.alias("html")))


# magic numbers of image formats (fixed values)
JPEG, PNG, GIF, BMP = "FFD8FF", "89504E470D0A1A0A", "474946383961", "424D"


def page_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Binary bodies derived from pages: an image signature chosen by the
    page language (en JPEG, fr PNG, es GIF, de BMP, others none, i.e. HTML
    served as an image) followed by the page bytes, or by the short
    language code for '#top' pages (bodies of 20 bytes or fewer)."""
    p = read_table(spark, sf, "pages").select("page_id", "url", "html")
    lang = F.regexp_extract("url", r"\A[a-z]+://[^/]*/([a-z]{2})/", 1)
    magic = (F.when(lang == "en", F.unhex(F.lit(JPEG))).when(lang == "fr", F.unhex(F.lit(PNG)))
             .when(lang == "es", F.unhex(F.lit(GIF))).when(lang == "de", F.unhex(F.lit(BMP)))
             .otherwise(F.unhex(F.lit(""))))
    rest = F.when(F.col("url").endswith("#top"), F.encode(lang, "UTF-8")).otherwise(F.encode("html", "UTF-8"))
    return p.select("page_id", "url", F.concat(magic, rest).alias("body"))
