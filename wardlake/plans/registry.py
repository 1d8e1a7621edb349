"""Query registry: every operator key -> (Spark builder, DuckDB oracle SQL).

Builders take ``(spark, sf_dir)`` and return a DataFrame. The oracle SQL is
written independently against the driver's tables (views named like the
Parquet files) and must produce the same column names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    key: str
    build: Builder
    sql: str | Callable[[], str] | None


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql)
        return fn

    return deco


def _load_all() -> None:
    # Importing the plan modules fills REGISTRY.
    from wardlake.plans import (  # noqa: F401
        access_plans,
        directory_plans,
        governed_plans,
        json_plans,
        log_plans,
        path_plans,
        policy_plans,
        retail_plans,
        stream_plans,
        tag_plans,
    )


def all_queries() -> dict[str, Builder]:
    _load_all()
    return {k: e.build for k, e in REGISTRY.items()}


def all_sql() -> dict[str, str]:
    _load_all()
    out = {}
    for k, e in REGISTRY.items():
        if e.sql is None:
            continue
        out[k] = e.sql() if callable(e.sql) else e.sql
    return out
