"""Predicates (FLT-1 to FLT-13) that need more than one Column expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.urls import hostname
from pageloom.functions.util import col_of


def host_suffixes(url) -> Column:
    """Every dot-suffix of a URL's host: ``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    parts = F.split(hostname(url), r"\.", -1)
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n),
                       lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))


def allowed_domain(links: DataFrame, domains: Iterable[str], spark: SparkSession | None = None,
                   url_col: str = "url") -> DataFrame:
    """FLT-11: keep links whose host equals or is a subdomain of an allowed
    domain.  The allow list is a small fixed parameter, so it becomes a
    literal array and the test is one expression per row (the host's dot
    suffixes overlap the list): no join, no shuffle, no broadcast."""
    allow = F.array(*[F.lit(d.lower()) for d in domains])
    return links.where(F.arrays_overlap(host_suffixes(F.col(url_col)), allow))


def reciprocal(pairs: DataFrame, marker: str) -> DataFrame:
    """FLT-4: pairs that link both ways and whose target holds ``marker``."""
    return (pairs.where((F.col("inboundfrom") == F.col("outboundto"))
                        & (F.col("inboundto") == F.col("outboundfrom"))
                        & F.col("inboundto").contains(marker))
            .select("id", "inboundfrom", "inboundto"))


def status_not_ok(status) -> Column:
    """FLT-10: HTTP status outside 200-299."""
    s = col_of(status)
    return (s >= 300) | (s < 200)
