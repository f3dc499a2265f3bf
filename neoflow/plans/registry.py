"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, with the
DuckDB oracle SQL kept next to each query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}


def register(name: str, sql: str | None = None, covers: list[str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        COVERS[name] = list(covers or [])
        return fn
    return deco


def register_subset(name: str, base: str, cols: list[str], covers: list[str] | None = None,
                    sql: str | None = None):
    """Register ``name`` as a column subset of the query ``base`` (and of its
    oracle, unless ``sql`` is given)."""
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[base](spark, sf_dir).select(*cols)
    fn.__name__ = name
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql
    elif base in ORACLES:
        ORACLES[name] = f"SELECT {', '.join(_q(c) for c in cols)} FROM ({ORACLES[base]}) AS base_q"
    COVERS[name] = list(covers or [])
    return fn


def _q(c: str) -> str:
    return f'"{c}"'
