"""Query registry: name -> (spark builder, oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the supplied
tables.  The oracle is ANSI SQL for DuckDB over the same tables (registered as
views by the checker).  Column names and types must match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    """Register a query builder; ``sql=None`` means rows-only checking."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        if headline:
            HEADLINE.append(name)
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from importlib import import_module

    for mod in ("scans", "cleaning", "joins", "aggregates", "statistics", "reshaping",
                "windows", "text", "documents", "learning", "streams", "reports"):
        import_module(f"sparkpanel.plans.{mod}")
