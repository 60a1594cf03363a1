"""Record extraction from structured page parts (EXT-5 to EXT-13).

Rows of listing tables, cells of info boxes, cards, pagers, nested lists:
elements are cut with what they nest, attributes count in any order.
Everything is a native expression over the ``html`` column; records become
arrays and are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.html import (Element, anchors, attribute, children, content, direct_texts, elements, first_direct_text,
                                     first_element, whole)
from pageloom.functions.text import between_markers, collapse_ws, first_text, html_unescape, strip_chars, strip_tags, ws_strip
from pageloom.functions.util import col_of, map_of
from pageloom.operators.frontier import unseen
from pageloom.operators.sets import fallback
from pageloom.operators.windows import first_by

# Label -> field map of the place info boxes, in the order
# the original parser lists them; a later cell of the same field wins.
LABEL_FIELDS = [
    ("简称", "short_name"),
    ("面积", "area"),
    ("人口密度", "population_dencity"),
    ("车牌号码", "license_prefix"),
    ("行政级别", "admin_level"),
    ("人口", "population"),
    ("长途区号", "tele_prefix"),
    ("行政代码", "admin_code"),
    ("辖区面积", "area"),
    ("邮政编码", "post_code"),
    ("身份证前六位", "idcard_prefix"),
]
# A label holding this marker after its first character is an address.
ADDRESS_MARKER = "地址"
# Abstract placeholder text of encyclopedia pages.
ABSTRACT_PLACEHOLDER = "添加摘要"

FIELDS = list(dict.fromkeys(f for _, f in LABEL_FIELDS)) + ["address"]

def label_field(label) -> Column:
    """Field name of a label: the fixed map as a literal map (no join)."""
    return F.try_element_at(F.expr(map_of(LABEL_FIELDS)), col_of(label))


def first_in(fragment, pattern: str) -> Column:
    """First capture of ``pattern``, entities decoded, ``''`` when absent."""
    return html_unescape(F.regexp_extract(col_of(fragment), pattern, 1))


def _first(found: Column) -> Column:
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(""))


# --- EXT-5 -------------------------------------------------------------------

LISTING = Element("table", (("bgcolor", "cccccc"), ("width", "738")))


def table_rows(pages: DataFrame, table: Element = LISTING) -> DataFrame:
    """The rows of all listing tables of a page but the first (the header):
    the first cell's bold link text and its ``tppabs`` attribute, ``''`` when
    absent (a row is kept even then, like the original).  Rows of tables
    inside a cell are not rows of the listing."""
    tables = pages.select("page_id", whole(elements("html", table)).alias("tables"))
    cells = tables.select("page_id", F.posexplode(elements("tables", Element("tr"), level=1)).alias("pos", "tr")).where(F.col("pos") > 0).select(
        "page_id", F.col("pos").cast("int").alias("pos"), _first(elements("tr", Element("td"), level=0)).alias("cell"))
    bold = cells.select("page_id", "pos", whole(elements("cell", Element("strong"))).alias("bold"))
    links = bold.select("page_id", "pos", _first(children("bold", "a", level=1)).alias("a"))
    return links.select("page_id", "pos", ws_strip(first_direct_text(content("a"))).alias("anchor_text"),
                        ws_strip(html_unescape(attribute("a", "tppabs"))).alias("url"))


# --- EXT-6 / EXT-7 / EXT-8 -----------------------------------------------------

def _pairs(cells, value_of) -> Column:
    """Cells of an info box as ``array<struct<label, value>>``."""
    return F.transform(cells, lambda td: F.struct(
        ws_strip(first_in(td, r"(?is)<strong\b[^>]*>([^<]*)")).alias("label"), value_of(td).alias("value")))


def _keyed(pairs: Column, with_address: Column) -> Column:
    """The cells that are mapped to a field, as ``array<struct<field, value>>``;
    those with an empty label or value and unknown labels are ignored."""
    def field_of(c):
        address = F.when(with_address & (F.instr(c["label"], ADDRESS_MARKER) > 1), F.lit("address"))
        return F.coalesce(label_field(c["label"]), address)
    valid = F.filter(pairs, lambda c: (F.length(c["label"]) > 0) & (F.length(c["value"]) > 0))
    keyed = F.transform(valid, lambda c: F.struct(field_of(c).alias("field"), c["value"].alias("value")))
    return F.filter(keyed, lambda c: c["field"].isNotNull())


def _field(keyed: str, name: str) -> Column:
    """The value of the last cell of a field: a later one wins."""
    return F.try_element_at(F.filter(keyed, lambda c: c["field"] == F.lit(name)), F.lit(-1))["value"].alias(name)


def _linked_value(td: Column) -> Column:
    """First direct text of a cell; if there is none, the text of its first link."""
    v = strip_chars(ws_strip(_first(direct_texts(td, level=1))), ":")
    link = F.coalesce(F.try_element_at(anchors(td), F.lit(1))["text"], F.lit(""))
    # nullif by way of an array: a plain ``when`` would compute v twice
    found = F.try_element_at(F.filter(F.array(v), lambda x: F.length(x) > 0), F.lit(1))
    return F.coalesce(found, ws_strip(link))


def _joined_value(td: Column) -> Column:
    """All direct texts of a cell, a line each."""
    return strip_chars(ws_strip(F.array_join(direct_texts(td, level=1), "\n")), ":")


def _box(width: str) -> Element:
    return Element("table", (("width", width), ("bgcolor", "cccccc")))


def _places(pages: DataFrame, province: Column, columns: tuple[str, ...]) -> DataFrame:
    """One row per page.  ``province`` pages: in the second table of the left
    part, the first cell of a row has the info box, the second the
    description.  Others: the cells of all 432px tables, else of the 396px
    ones.  A step at a time, each on the columns of the one before; a page is
    read once, by the rules that are its own."""
    def when(of_province, of_sub) -> Column:
        return F.when(F.col("province"), of_province).otherwise(of_sub)

    def of_class(cls: str) -> Column:
        return whole(elements("html", Element("div", (("class", cls),))))

    none, no_text = F.array().cast("array<string>"), F.lit("")
    left = first_element("html", Element("div", (("id", "page_left"),)), inner=True)
    rows = pages.select("page_id", province.alias("province"), ws_strip(first_in("html", r"(?i)<h1\b[^>]*>([^<]*)")).alias("title"), "html")
    rows = rows.select("page_id", "province", "title", when(left, no_text).alias("left"), when(none, elements("html", _box("432px"))).alias("a"),
                       when(none, elements("html", _box("396px"))).alias("b"), when(no_text, of_class("f14")).alias("f14"),
                       when(no_text, of_class("f12")).alias("f12"))
    fixed = ["page_id", "province", "title", "f12"]
    rows = rows.select(*fixed, "f14", "a", "b", F.coalesce(F.try_element_at(children("left", "table"), F.lit(2)), no_text).alias("table"))
    rows = rows.select(*fixed, "f14", "a", "b", elements("table", Element("tr"), level=1).alias("outer"))
    rows = rows.select(*fixed, "f14", "a", "b", F.transform("outer", lambda tr: elements(tr, Element("td"), level=0)).alias("outer"))
    second = whole(F.transform("outer", lambda tds: F.coalesce(F.try_element_at(tds, F.lit(2)), F.lit(""))))
    rows = rows.select(*fixed, when(second, F.col("f14")).alias("texts"), "a", "b", whole(F.transform("outer", _first)).alias("firsts"))
    rows = rows.select(*fixed, "texts", "b", when(elements("firsts", Element("table"), level=0), F.col("a")).alias("a"))
    rows = rows.select(*fixed, "texts", *[elements(whole(F.col(c)), Element("tr"), level=1).alias(c) for c in "ab"])
    rows = rows.select(*fixed, "texts", *[elements(whole(F.col(c)), Element("td"), level=0).alias(c) for c in "ab"])
    rows = rows.select(*fixed, "texts", F.when(F.size("a") > 0, F.col("a")).otherwise(F.col("b")).alias("cells"))
    rows = rows.select("page_id", "province", "title", F.array_join(direct_texts("texts", level=1), "\n").alias("description"),
                       F.when(~F.col("province"), F.array_join(direct_texts("f12", level=1), "\n")).alias("f12"),
                       when(_pairs("cells", _linked_value), _pairs("cells", _joined_value)).alias("pairs"))
    rows = rows.select("page_id", "title", "description", "f12", _keyed(F.col("pairs"), F.col("province")).alias("keyed"))
    return rows.select("page_id", *columns, *[_field("keyed", f) for f in FIELDS])


def province_info(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """EXT-6: province layout.  Value = first direct text of the cell,
    whitespace-stripped then ``:``-stripped (in that order, once); when that
    is empty, the cell's first link text.  Unknown labels are dropped; an
    address is a label containing the marker after its first character.
    Title from ``h1``; description = direct texts of the second outer cells
    joined by newlines.  One row per page with every field column."""
    return _places(pages, F.lit(True), ("title", "description"))


def sub_info(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """EXT-7: sub-page layout.  Cells of all 432px tables, else of the 396px
    ones (SET-3, per page); value = all direct texts joined by newline,
    stripped, then ``:``-stripped; no link fallback, no address rule.
    ``description`` from all ``f14`` blocks, ``f12`` from the ``f12`` blocks."""
    return _places(pages, F.lit(False), ("title", "description", "f12"))


def page_kind_branch(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """EXT-8: ``pid == 0`` pages use the province layout, others (not those
    without ``pid``) the sub-page layout.  Every page is read once, by the
    branch that is its own."""
    return _places(pages.where(F.col("pid").isNotNull()), F.col("pid") == 0, ("title", "description", "f12"))


# --- EXT-10 ------------------------------------------------------------------

def title_price_rows(pages: DataFrame) -> DataFrame:
    """Title (``td/h3/a``) and price (third cell's nested spans) of every
    body row; a missing one is NULL, the row is kept."""
    body = F.regexp_extract("html", r"(?is)<tbody\b[^>]*>(.*?)</tbody>", 1)
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)).alias("pos", "tr"))
    title = F.regexp_extract("tr", r"(?is)<td\b[^>]*>\s*<h3\b[^>]*>\s*<a\b[^>]*>([^<]*)", 1)
    cells = F.regexp_extract_all("tr", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1)
    third = F.try_element_at(cells, F.lit(3))
    price = F.regexp_extract(third, r"(?is)<p\b[^>]*>\s*<span\b[^>]*>\s*<span\b[^>]*>\s*<span\b[^>]*>([^<]*)", 1)
    has_title = F.col("tr").rlike(r"(?is)<td\b[^>]*>\s*<h3\b[^>]*>\s*<a\b[^>]*>[^<]")
    has_price = F.coalesce(third.rlike(r"(?is)<p\b[^>]*>\s*<span\b[^>]*>\s*<span\b[^>]*>\s*<span\b[^>]*>[^<]"), F.lit(False))
    return rows.select("page_id", (F.col("pos") + 1).cast("int").alias("pos"),
                       F.when(has_title, ws_strip(html_unescape(title))).alias("title"),
                       F.when(has_price, ws_strip(html_unescape(price))).alias("price"))


# --- EXT-11 / EXT-12 / EXT-13 --------------------------------------------------

def _class(cls: str, tag: str = "div") -> Element:
    return Element(tag, (("class", cls),))


def _text_in(card: Column, cls: str) -> Column:
    """First direct text of the first paragraph of a class."""
    return first_text(first_direct_text(first_element(card, _class(cls, "p"), inner=True)))


def _link_in(card: Column, element: Element) -> Column:
    """The first anchor of the first such element of a card."""
    none = F.struct(F.lit("").alias("href"), F.lit("").alias("text"))
    return F.coalesce(F.try_element_at(anchors(first_element(card, element, inner=True)), F.lit(1)), none)


def _title_and_text(card: Column) -> list[Column]:
    return [first_text(_link_in(card, Element("h2"))["text"]).alias("title"), _text_in(card, "man mts").alias("description")]


def attraction_cards(pages: DataFrame) -> DataFrame:
    """EXT-11 with SET-3: layout A cards when the page has any, else layout
    B cards; ``href, title, description`` per card (S-3 clean-up).  A card
    ends with its own element."""
    zones = pages.select("page_id", whole(elements("html", _class("unit size1of3"), level=0)).alias("zones"),
                         elements("html", _class("media product-summary mtn mhn")).alias("b"))
    both = zones.select("page_id", elements("zones", _class("ttd-row-height")).alias("a"), "b")
    cards = both.select("page_id", (F.size("a") > 0).alias("is_a"), F.posexplode(fallback("a", "b")).alias("pos", "c"))
    image = F.when(F.col("is_a"), _link_in(F.col("c"), _class("product-image"))["href"]).otherwise(_link_in(F.col("c"), _class("img mrl prs"))["href"])
    return cards.select("page_id", (F.col("pos") + 1).cast("int").alias("pos"), first_text(image).alias("href"), *_title_and_text(F.col("c")))


def pager_links(pages: DataFrame, site: str) -> DataFrame:
    """EXT-12: links of the first pager only, prefixed with the site;
    ``page_id`` is the parent."""
    pager = first_element("html", _class("txtR mhn mbl", "p"))
    return (pages.select("page_id", F.posexplode(anchors(pager)).alias("pos", "a"))
            .select(F.col("page_id").alias("parent_id"), (F.col("pos") + 1).cast("int").alias("pos"),
                    F.concat(F.lit(site), F.col("a.href")).alias("href")))


def new_pager_links(pages: DataFrame, stored: DataFrame, site: str, first_pages: Column | None = None) -> DataFrame:
    """EXT-12 as the crawl stores it: pager links whose URL is not stored yet
    (column ``href`` of ``stored``), once each, with the page where they occur
    first as parent.  With ``first_pages`` (a condition on the pages) only the
    pagers of such pages count."""
    links = pager_links(pages if first_pages is None else pages.where(first_pages), site)
    firsts = first_by(links, ["href"], ["parent_id", "pos"], [])
    return unseen(firsts, stored, key="href").select("href", F.col("parent_id").alias("pid"))


def product_cards(pages: DataFrame) -> DataFrame:
    """EXT-13: product cards -- link, title, description, location, and
    price = every price block (markup kept) joined by ``.``, tags stripped,
    newlines to spaces, whitespace collapsed.  A card ends with its own
    element."""
    cards = pages.select("page_id", F.posexplode(elements("html", _class("media product-summary mhn mtn"))).alias("pos", "c"))
    prices = F.array_join(elements("c", _class("product-price txtR")), ".")
    return cards.select("page_id", (F.col("pos") + 1).cast("int").alias("pos"),
                        first_text(_link_in(F.col("c"), _class("img product-image mrl"))["href"]).alias("href"), *_title_and_text(F.col("c")),
                        _text_in(F.col("c"), "man mts note xsmall").alias("location"),
                        collapse_ws(ws_strip(F.replace(strip_tags(prices), F.lit("\n"), F.lit(" ")))).alias("price"))


# --- EXT-14 ------------------------------------------------------------------

def nested_list_links(pages: DataFrame, site: str) -> DataFrame:
    """EXT-14: in the first list on the own level of the ``bd`` block, the
    group links of the items (those ending in 'ttd' skipped) and the links of
    the items' own lists with the group's URL; texts and links stripped;
    absolute links are dropped and relative ones prefixed with the site
    (S-11).  ``page_id, level, pos, anchor_text, href, parent_href``."""
    block = pages.select("page_id", first_element("html", _class("bd"), inner=True).alias("bd"))
    items = block.select("page_id", _first(children("bd", "ul")).alias("list")).select("page_id", F.posexplode(children("list", "li", level=1)).alias("item", "li"))
    own = items.select("page_id", "item", children("li", "a", level=1).alias("groups"), children("li", "ul", level=1).alias("lists"))
    subs = own.select("page_id", "item", "groups", children(whole(F.col("lists")), "li", level=1).alias("inner"))
    subs = subs.select("page_id", "item", "groups", children(whole(F.col("inner")), "a", level=1).alias("subs"))
    links = subs.select("page_id", "item", anchors(whole(F.col("groups"))).alias("groups"), anchors(whole(F.col("subs"))).alias("subs"))

    def link(level: int, a: Column, parent: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), ws_strip(a["text"]).alias("text"), ws_strip(a["href"]).alias("href"), parent.alias("parent"))

    records = F.flatten(F.transform("groups", lambda g: F.concat(
        F.array(link(1, g, F.lit(None).cast("string"))), F.transform("subs", lambda s: link(2, s, ws_strip(g["href"]))))))
    found = links.select("page_id", "item", F.posexplode(records).alias("place", "a"))
    href, level = F.col("a.href"), F.col("a.level")
    # the place within the page: that of the item, then within it
    return found.where(~href.startswith("http") & ~((level == 1) & href.endswith("ttd"))).select(
        "page_id", level.alias("level"), (F.col("item").cast("bigint") * (1 << 20) + F.col("place")).alias("pos"),
        F.col("a.text").alias("anchor_text"), F.concat(F.lit(site), href).alias("href"),
        F.when(level == 2, F.concat(F.lit(site), F.col("a.parent"))).alias("parent_href"))


# --- EXT-9 -------------------------------------------------------------------

def best_description(pages: DataFrame, keep=()) -> DataFrame:
    """EXT-9 cascade, first hit wins:
    1. the abstract paragraph, unless it holds the placeholder -- returned
       even when its stripped text is empty;
    2. the content block's first paragraph when its stripped text is longer
       than 100 characters;
    3. the stripped text between the two heading markers of the content
       block (returned even when empty; ``''`` when a marker is missing);
    4. ``''`` when there is no content block.
    Blocks end with their own end tags; a paragraph is a child of its block,
    wherever it stands there.  ``keep`` names page columns to carry along (so
    callers need no self-join)."""
    keep = list(keep)
    prompt = first_element("html", Element("div", (("id", "unifyprompt"),)), inner=True)
    cut = pages.select("page_id", *keep, prompt.alias("prompt"), first_element("html", Element("div", (("id", "content"),))).alias("content"))
    cut = cut.select("page_id", *keep, whole(children("prompt", "div")).alias("inner"), content("content").alias("inside"), "content")
    cut = cut.select("page_id", *keep, children("inner", "p", level=1).alias("abstracts"), _first(children("inside", "p")).alias("p"), "content")
    staged = cut.select("page_id", *keep, "content", F.try_element_at("abstracts", F.lit(1)).alias("abstract"),
                        strip_tags("p").alias("p_text"))
    section = between_markers("content", 'class="content_h2 bac_no">', '<div class="content_h2">', 0, True)["text"]
    desc = (F.when(F.col("abstract").isNotNull() & ~F.contains(F.col("abstract"), F.lit(ABSTRACT_PLACEHOLDER)), strip_tags("abstract"))
            .when(F.length("p_text") > 100, F.col("p_text"))
            .when(F.length("content") > 0, strip_tags(section))
            .otherwise(F.lit("")))
    return staged.select("page_id", *keep, desc.alias("description"))
