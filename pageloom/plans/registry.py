"""Registry of named queries: a Spark builder ``(spark, sf_dir) ->
DataFrame`` and, where the job is expressible in SQL, the DuckDB oracle
text over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the plan modules fills the registry
    from pageloom.plans import q_pages, q_tables, q_trees, q_fixtures, q_stream  # noqa: F401
