"""Page-table extraction jobs (EXT-1 to EXT-4, EXT-11, EXT-12, EXT-15).

Every job is ``pages DataFrame -> records DataFrame``: a block is cut with
its nested elements, its records become an array column and are exploded.
Only ``page_id``/``url``/``html`` are projected before the expressions, so
the parquet scan reads those columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.html import Element, anchors, block, elements, first_element
from pageloom.functions.text import strip_tags, ws_strip
from pageloom.functions.urls import absolutize, absolutize_rooted


def block_anchors(pages: DataFrame, tag: str = "nav", attr: str | None = None,
                  value: str | None = None, prefix: bool = False, extra=()) -> DataFrame:
    """EXT-1: every anchor inside the first matching block of each page:
    ``page_id, page_url, pos (1-based), href, text`` (+ ``extra`` page
    columns carried along)."""
    extra = list(extra)
    return (pages.select("page_id", F.col("url").alias("page_url"), *extra,
                         F.posexplode(anchors(block("html", tag, attr, value, prefix))).alias("pos", "a"))
            .select("page_id", "page_url", *extra, (F.col("pos") + 1).cast("int").alias("pos"),
                    F.col("a.href").alias("href"), F.col("a.text").alias("text")))


def page_links(pages: DataFrame, tag: str = "nav", attr: str | None = None,
               value: str | None = None, extra=()) -> DataFrame:
    """EXT-2 (with FLT-6, S-8, S-9): links of a filter block, lower-cased,
    absolutised on the page's netloc; links whose text or URL is empty are
    dropped.  Columns ``page_id, pos, anchor_text, url`` (+ ``extra``)."""
    a = block_anchors(pages, tag, attr, value, extra=extra)
    href = F.lower(F.col("href"))
    return (a.where((F.length("text") > 0) & (F.length("href") > 0))
            .select("page_id", "pos", *list(extra), F.col("text").alias("anchor_text"),
                    absolutize(href, F.col("page_url")).alias("url")))


def fragment_links(rows: DataFrame, columns=("subway", "district"), url_col: str = "url") -> DataFrame:
    """EXT-4 (S-10): anchors of stored HTML fragments, relative to the row's
    own URL.  Only non-empty fragments are read; title and URL are both
    required.  Columns ``id, source, pos, anchor_text, url``."""
    stacked = rows.select(
        "id", F.col(url_col).alias("src_url"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).alias("frag")) for c in columns])).alias("s"))
    stacked = stacked.where(F.length("s.frag") > 0)
    a = stacked.select("id", "src_url", F.col("s.source").alias("source"),
                       F.posexplode(anchors(F.col("s.frag"))).alias("pos", "a"))
    return (a.where((F.length("a.text") > 0) & (F.length("a.href") > 0))
            .select("id", "source", (F.col("pos") + 1).cast("int").alias("pos"),
                    F.col("a.text").alias("anchor_text"),
                    absolutize_rooted(F.col("a.href"), F.col("src_url")).alias("url")))


def tagged_anchors(pages: DataFrame, blocks: Sequence[tuple[str, Element]]) -> DataFrame:
    """SET-1: the anchors of several blocks of each page, tagged with the
    block's name (``source, page_id, pos, href, text``); every page is read
    once."""
    lists = F.array(*[F.struct(F.lit(name).alias("source"), anchors(first_element("html", e)).alias("found")) for name, e in blocks])
    each = pages.select("page_id", F.explode(lists).alias("b"))
    return each.select(F.col("b.source").alias("source"), "page_id", F.posexplode("b.found").alias("pos", "a")).select(
        "source", "page_id", (F.col("pos") + 1).cast("int").alias("pos"), F.col("a.href").alias("href"), F.col("a.text").alias("text"))


def list_items(pages: DataFrame) -> DataFrame:
    """EXT-15 (SET-2): text of the first link of every list item (those of
    inner lists too), stripped, concatenated over all pages.  A list item
    without a link is skipped."""
    items = pages.select("page_id", F.posexplode(elements("html", Element("li"))).alias("pos", "li"))
    first = F.try_element_at(anchors(F.col("li")), F.lit(1))
    return (items.select("page_id", (F.col("pos") + 1).cast("int").alias("pos"), first.alias("a"))
            .where(F.col("a").isNotNull())
            .select("page_id", "pos", ws_strip(F.col("a.text")).alias("item")))


#: The blocks of the given pages: the filter block, one by the beginning of its class, one by its tag.
PAGE_BLOCKS = {"area": Element("nav"), "subway": Element("div", (("class^", "a"),)), "district": Element("footer")}


def html_blocks(pages: DataFrame, blocks: dict[str, Element] = PAGE_BLOCKS) -> DataFrame:
    """EXT-3: raw HTML of the first element of each kind (column name ->
    which one), markup and nested elements kept; ``''`` where a page has
    none."""
    return pages.select("page_id", "url", *[first_element("html", e).alias(name) for name, e in blocks.items()])


def site_links(pages: DataFrame, site: str, tag: str = "nav") -> DataFrame:
    """S-11: anchors (text and href stripped) prefixed with a fixed site;
    absolute links are dropped, as the list builder this mirrors does."""
    a = block_anchors(pages, tag)
    href = ws_strip(F.col("href"))
    return (a.where(~href.startswith("http"))
            .select("page_id", "pos", ws_strip(F.col("text")).alias("anchor_text"),
                    F.concat(F.lit(site), href).alias("href")))


def page_outcome(pages: DataFrame, records: DataFrame) -> DataFrame:
    """S-21: per page, ``done`` when records were found else ``passed``
    (left join, so pages without records count 0), and ``succ``/``failed``
    by the length (> 10) of the stripped footer text."""
    counts = records.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    desc = strip_tags(block("html", "footer"))
    # the page body is reduced to its flag before the join: html is never shuffled
    flags = pages.select("page_id", F.when(F.length(desc) > 10, "succ").otherwise("failed").alias("desc_flag"))
    return (flags.join(counts, "page_id", "left")
            .select("page_id", n.alias("n_links"),
                    F.when(n > 0, "done").otherwise("passed").alias("flag"), "desc_flag"))
