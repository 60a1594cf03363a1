"""Incremental and iterative crawl jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import frontier as FR
from pageloom.operators.extract import page_links
from pageloom.plans.q_pages import PAGE_LINKS_SQL
from pageloom.plans.q_trees import GEO_SQL, geo_tree
from pageloom.plans.registry import register
from pageloom.sources.tables import literal_seeds, read_table
from pageloom.streaming.stream_links import LINKS_SCHEMA, run_link_intake


@register("stream_links", f"SELECT DISTINCT url FROM ({PAGE_LINKS_SQL})")
def q_stream_links(spark, sf):
    """STR-1: the page table consumed as a stream of files; the stored link
    table holds each URL once (equal to the batch first-occurrence keys)."""
    table = run_link_intake(spark, sf, glob="pages.parquet")
    return spark.read.schema(LINKS_SCHEMA).parquet(table).select("url")


@register("unmatched_links", f"""
SELECT url, count(*) AS n_rows FROM ({PAGE_LINKS_SQL}) l
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = l.url) GROUP BY url
""")
def q_unmatched_links(spark, sf):
    """JOIN-4's report: link targets that no crawled page has, and how many
    links the lookup of the page's id drops."""
    pages = read_table(spark, sf, "pages")
    return FR.unmatched(page_links(pages.select("page_id", "url", "html")), pages, "url")


#: The seed sites of the literal list.
SEEDS = ["example.com", "example.org"]
_SITE_RE = r"^[a-z]+://(?:[^/?#]*\.)?([^./?#]+\.[^./?#]+)(?:[/?#]|$)"


@register("literal_seed_pages", f"""
SELECT s.seed_pos, p.page_id, s.url AS url FROM (VALUES (0, 'example.com'), (1, 'example.org')) s(seed_pos, url)
JOIN (SELECT page_id, regexp_extract(url, '{_SITE_RE}', 1) AS site FROM pages) p ON p.site = s.url
""")
def q_literal_seed_pages(spark, sf):
    """SRC-2: the pages of a literal list of seed sites (the list is a local
    relation of known size, so the pages are not shuffled)."""
    pages = read_table(spark, sf, "pages").select("page_id", F.regexp_extract("url", _SITE_RE, 1).alias("url"))
    return FR.seed_pages(literal_seeds(spark, SEEDS), pages).select("seed_pos", "page_id", "url")


@register("link_depth", f"""
WITH RECURSIVE n AS ({GEO_SQL}),
walk AS (SELECT id, 0 AS depth FROM n WHERE pid = 0
         UNION ALL SELECT c.id, w.depth + 1 FROM walk w JOIN n c ON c.pid = w.id)
SELECT id AS node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY id
""")
def q_link_depth(spark, sf):
    """FRN-2 over the geo hierarchy's parent->child edges, crawled from the
    roots to a fixpoint; orphans are never reached."""
    g = geo_tree(spark, sf)
    edges = g.where(F.col("pid").isNotNull()).select(F.col("pid").alias("src"), F.col("id").alias("dst"))
    seeds = g.where(F.col("pid") == 0).select(F.col("id").alias("node"))
    return FR.crawl_to_fixpoint(edges, seeds)
