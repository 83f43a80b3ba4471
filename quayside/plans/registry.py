"""Registry of named queries: Spark callables and their independent SQL oracles.

``register(name, oracle_sql)`` decorates a ``(spark, sf_dir) -> DataFrame`` function.
``oracle_sql=None`` marks a query whose result depends on files it writes itself (sizes,
round trips) or is not expressible in SQL; it gets a rows-only check and its own test.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in ("q_facts", "q_kpis", "q_dashboard", "q_joins", "q_explore", "q_tracks", "q_sources", "q_stored", "q_intervals"):
        try:
            importlib.import_module(f"quayside.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"quayside.plans.{mod}":
                raise
