"""Crawl frontier (FRN-1, FRN-2, JOIN-2, JOIN-3, JOIN-9, WIN-2).

One round: pages of pending seeds -> links -> normalise -> first occurrence
of each URL -> not yet known -> new seeds (``url, anchor_text, parent_id,
flag``).  Two shuffles, both hashed on the normalised URL: the partial
aggregate that keeps the first occurrence (hot URLs collapse map-side) and
the anti join against the distinct known URLs, which reuses that
partitioning on the new side.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageloom.operators.extract import page_links
from pageloom.operators.windows import first_by
from pageloom.session import materialize, materialize_bucketed


def first_link_occurrence(links: DataFrame) -> DataFrame:
    """WIN-2: the first occurrence of every URL in page order wins."""
    return first_by(links, ["url"], ["page_id", "pos"], ["anchor_text"])


def unseen(links: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """JOIN-2: links whose key is not in ``known`` (anti join).  The known
    side is de-duplicated first, so a hot key is collapsed before it is
    shuffled."""
    return links.join(known.select(key).distinct(), key, "left_anti")


def already_seen(links: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """JOIN-3: the complement of :func:`unseen` (semi join).  ``links`` may
    hold a key many times: the distinct known keys are written first, so that
    the join has two plain inputs and a hot key of ``links`` is split."""
    return links.join(materialize(known.select(key).distinct(), "known"), key, "left_semi")


def unmatched(rows: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """JOIN-4's report: every key of ``rows`` that the catalogue lacks, with
    the number of rows that the lookup drops for it."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(catalogue.select(key), key, "left_anti")


def seed_pages(seeds: DataFrame, pages: DataFrame, key: str = "url") -> DataFrame:
    """JOIN-9: carry each seed row to its page (equi join on the URL)."""
    return seeds.join(pages, key, "inner")


def crawl_frontier(pages: DataFrame, known: DataFrame, tag: str = "nav",
                   flag: str = "init") -> DataFrame:
    """FRN-1: new seed rows discovered on ``pages`` that ``known`` lacks."""
    links = page_links(pages.select("page_id", "url", "html"), tag)
    first = first_link_occurrence(links)
    fresh = unseen(first, known)
    return fresh.select("url", "anchor_text", F.col("page_id").alias("parent_id"),
                        F.lit(flag).alias("flag"))


def _spread(edges: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """``edges`` with ``part``, 0 but for sources with more than an even
    bucket's share of all edges, whose edges go to as many parts as make each
    about half a share; and those sources (``hub, parts``): fewer than
    ``buckets`` of them, whatever the edges are."""
    degrees = materialize(edges.groupBy(F.col("src").alias("hub")).agg(F.count(F.lit(1)).alias("n")), "degrees")
    share = (degrees.agg(F.sum("n")).first()[0] or 0) / buckets
    hubs = (degrees.where((F.col("n") > share) & F.col("hub").isNotNull())
            .select("hub", F.ceil(F.col("n") * 2 / F.lit(share or 1.0)).cast("int").alias("parts")))
    at = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int"), F.lit(0))
    parted = edges.join(F.broadcast(hubs), F.col("src") == F.col("hub"), "left")
    return parted.select("src", at.alias("part"), "dst"), hubs


def _links_from(frontier: DataFrame, edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """Nodes one link away from ``frontier(node)``; a hub meets each part of its edges."""
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    asked = frontier.join(F.broadcast(hubs), F.col("node") == F.col("hub"), "left").select(F.col("node").alias("src"), parts.alias("part"))
    return asked.join(edges, ["src", "part"]).select(F.col("dst").alias("node"))


def _not_in(nodes: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Nodes in none of the tables, one anti join each: a union of bucketed
    tables would be shuffled, a bucketed table is not."""
    return reduce(lambda left, table: left.join(table.select("node"), "node", "left_anti"), tables, nodes)


def crawl_to_fixpoint(edges: DataFrame, seeds: DataFrame, compact_every: int = 8) -> DataFrame:
    """FRN-2: repeat the frontier round until no new node appears.
    ``edges(src, dst)`` (those with a NULL lead nowhere), ``seeds(node)``;
    returns ``node, depth`` with the round in which each node was first reached (link depth).

    The edges are written once, in hash buckets of their source (a hub's
    edges in several parts, so that no bucket is much larger than the rest),
    and every round's new nodes once, in hash buckets of the node.  A round
    moves the frontier to the edges and the nodes it reaches (a
    partial-aggregate distinct) to the nodes seen so far; neither the edges
    nor the seen nodes are shuffled again.  The seen tables are compacted
    into one every ``compact_every`` rounds.  The emptiness test is an
    observation on the round's own write."""
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted, hubs = _spread(edges.select("src", "dst").dropna(), buckets)
    e = materialize_bucketed(parted, ["src", "part"], "edges")
    parts = [materialize_bucketed(seeds.select("node").distinct().withColumn("depth", F.lit(0)), ["node"], "round", together=True)]
    frontier = parts[0].select("node")
    for depth in count(1):  # as deep as the links go
        reached = _links_from(frontier, e, hubs).distinct()
        obs = Observation()
        new = materialize_bucketed(_not_in(reached, parts).withColumn("depth", F.lit(depth))
                                   .observe(obs, F.count(F.lit(1)).alias("n")), ["node"], "round", together=True)
        if obs.get["n"] == 0:
            return reduce(DataFrame.unionByName, parts)
        parts.append(new)
        frontier = new.select("node")
        if len(parts) > compact_every:
            parts = [materialize_bucketed(reduce(DataFrame.unionByName, parts), ["node"], "seen")]
