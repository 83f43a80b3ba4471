"""Queries of this subpackage and their DuckDB SQL (absent where SQL cannot express the operator)."""
from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "op1_pii", "op2_line_dedup", "op3_quality_rules", "op4_token_counts", "op5_embedding_dedup", "op6_mixing", "op7_quality_classifier", "op8_chat_format", "op9_simhash", "op10_bpe",
    "op11_ann", "op12_divergence", "op13_prefix_trie",
)


def register(name: str, oracle_sql: str | None = None):
    """Decorator: adds a ``(spark, sf_dir) -> DataFrame`` query under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def load_all() -> None:
    """Import every operator module, so that its query is registered."""
    for m in MODULES:
        importlib.import_module(f"quayside.llm.{m}")
