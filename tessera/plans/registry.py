"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver
tables.  The oracle SQL is the same query written against DuckDB views of the
same tables; ``None`` means no SQL form exists and the check is rows-only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    import importlib

    for mod in _MODULES:
        importlib.import_module(f"tessera.plans.{mod}")


_MODULES = ("corpus", "bayes", "text", "labels", "spans", "relations", "similarity", "indexes", "lm", "augment", "lookup", "io")
