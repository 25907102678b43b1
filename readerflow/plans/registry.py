"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables (or data Spark derives from them). Column names are aliased
identically in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    """Decorator registering a query builder under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from . import q_books, q_dialogues, q_practice, q_conversation, q_inference, q_sources, q_streaming  # noqa: F401

    return REGISTRY
