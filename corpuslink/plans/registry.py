"""Registry of catalogue queries: a Spark builder plus its DuckDB oracle (or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: ``@register("top_links_all", oracle=SQL)``; ``None`` = rows-only check."""
    def deco(fn: QueryFn) -> QueryFn:
        old = QUERIES.get(name)
        if old is not None and (old[0].__module__, old[0].__qualname__) != \
                (fn.__module__, fn.__qualname__):
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # Importing the catalogue modules fills QUERIES.
    from corpuslink.plans import (  # noqa: F401
        catalog_io, catalog_links, catalog_quality, catalog_relational, catalog_text,
        catalog_sql, catalog_upsert, catalog_vectors,
    )
    return QUERIES
