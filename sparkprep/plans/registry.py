"""Registered queries: each key maps to a Spark function ``(spark, sf_dir) ->
DataFrame`` over the driver tables and, when the operator is relational,
an equivalent DuckDB SQL string (the oracle). Trap inputs (nulls,
duplicates, placeholders) are derived from the tables by the same
deterministic expression on both sides.

Floating outputs are plain doubles on both sides: the summation order moves
their last digits only, and rounding would turn such a move at a tie into a
difference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib

    for name in ("q_clean", "q_profile", "q_encode", "q_features", "q_model", "q_drift", "q_train", "q_boost", "q_io", "q_streams"):
        importlib.import_module(f"{__package__}.{name}")
