"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's parquet tables; ``__spark_entry__`` exposes them. Computed columns
carry the same alias on both sides so the driver's compare lines up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


MODULES = ("q_cube", "q_clean", "q_quality", "q_stats", "q_serve", "q_ingest", "q_ml", "q_monthly")


def load() -> tuple[dict, dict]:
    """Import every query module (importing registers its queries) and
    return (QUERIES, ORACLE)."""
    import importlib
    for m in MODULES:
        importlib.import_module(f"gridcube.plans.{m}")
    return QUERIES, ORACLE
