"""Derived catalogue jobs (GEN-1 to GEN-3, LNK-1, ENR-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import default_scheme, first_capture, host, path_token, remove_all
from pageloom.operators.filters import status_not_ok
from pageloom.session import materialize
from pageloom.sources.locator import fetch, located

_PATH_RE = r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*"


def url_path(url) -> F.Column:
    """Path (with query) of an absolute URL, or the URL itself if relative."""
    return F.regexp_replace(url if not isinstance(url, str) else F.col(url), _PATH_RE, "")


def url_derived_keys(rows: DataFrame, url_col: str = "url", id_col: str = "page_id",
                     group_re: str = "/([0-9]+)", dest_re: str = "d([0-9]+)",
                     dest_suffix: str = "-attractions") -> DataFrame:
    """GEN-1: group and destination keys cut from the URL path in one
    projection: ``dgroup`` = second-to-last token, ``dgroupid`` = 'g' + first
    group capture (NULL when absent), ``destination`` = token 1 without the
    suffix, ``destinationid`` = capture in the last token, default '0'."""
    p = url_path(url_col)
    return (rows.select(id_col, p.alias("_p"))
            .select(id_col,
                    path_token("_p", -2).alias("dgroup"),
                    F.concat(F.lit("g"), first_capture("_p", group_re)).alias("dgroupid"),
                    remove_all(path_token("_p", 1), dest_suffix).alias("destination"),
                    first_capture(path_token("_p", -1), dest_re, "0").alias("destinationid")))


def bad_url_shape(rows: DataFrame, suffix: str, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """GEN-2 / FLT-8: rows whose first path token does not end with
    ``suffix`` (URL-shape audit)."""
    tok = path_token(F.substr(url_path(url_col), F.lit(2)), 0)
    return rows.select(id_col, tok.alias("tok")).where(~F.col("tok").endswith(suffix))


def link_pairs(pages: DataFrame) -> DataFrame:
    """Link-exchange rows derived from every page (fixture rule): the source
    URL without an ``http://`` scheme, the expected target is the host for
    '#top' pages and host+path otherwise, https pages are reciprocal."""
    no_http = F.when(F.col("url").startswith("http://"), F.substr("url", F.lit(8))).otherwise(F.col("url"))
    target = F.when(F.col("url").endswith("#top"), host("url")).otherwise(F.concat(host("url"), url_path("url")))
    return pages.select(F.col("page_id").alias("id"), no_http.alias("inboundfrom"), target.alias("inboundto"),
                        F.when(F.col("url").startswith("https:"), target).otherwise(F.lit("")).alias("outboundfrom"),
                        no_http.alias("outboundto"))


def with_status(pages: DataFrame) -> DataFrame:
    """Fixture status column for pages (301 for feed links, 404 for pager
    URLs, else 200)."""
    return pages.withColumn("status", F.when(F.col("url").contains("utm_source"), 301)
                            .when(F.col("url").contains("?page="), 404).otherwise(200))


def backlink_check(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """LNK-1 / JOIN-8: for every expected link, fetch the source page (join
    on the URL with a default scheme) and give ``status:N`` when the status
    is not 2xx, else ``matched``/``missed`` by whether the body holds the
    target.

    ``pages(url, html, status)`` is a table of Parquet files, or columns
    computed over one that holds ``html``: the join moves URLs and places, and
    the bodies of pages with a good status are read where they lie."""
    req = pairs.select(F.col("id").alias("linkexchangesid"), default_scheme("inboundfrom").alias("url"), "inboundto")
    j = materialize(req.join(located(pages, "url", "status"), "url").drop("url"), "backlinks")
    bad = F.coalesce(status_not_ok(F.col("status")), F.lit(False))
    told = j.where(bad).select("linkexchangesid", F.concat(F.lit("status:"), F.col("status").cast("string")).alias("flag"))
    read = fetch(j.where(~bad).drop("status"), pages, "html")
    held = F.when(F.contains("html", "inboundto"), "matched").otherwise("missed")
    return told.unionByName(read.select("linkexchangesid", held.alias("flag")))
