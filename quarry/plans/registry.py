"""Name -> (Spark analysis, oracle SQL) registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL
    (``None`` for property-checked analyses: models, random output)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate analysis {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from quarry.sources.files import load_table

    return load_table(spark, sf_dir, name)
