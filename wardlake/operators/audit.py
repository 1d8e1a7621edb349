"""Audit rows and their summary (AGG-03, GOV-18, LOG-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FMT = "yyyy-MM-dd HH:mm:ss"


def audit_rows(decided: DataFrame) -> DataFrame:
    """GOV-18: only requests decided by an audit-enabled policy emit a row."""
    return decided.where(F.coalesce("is_audit_enabled", F.lit(False)))


def audit_summary(decided: DataFrame, window: str = "1 hour") -> DataFrame:
    """AGG-03: repeats of (user, resource, access, result) collapse per window.

    One hash aggregate, partial before the shuffle: a user who repeats one
    request millions of times costs one row per map task.
    """
    return (
        decided.groupBy("user", "db", "tbl", "col", "access", "decision", F.window("ts", window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("_first"), F.max("ts").alias("_last"))
        .select("user", "db", "tbl", "col", "access", "decision",
                F.date_format("w.start", FMT).alias("window_start"), "n_events",
                F.date_format("_first", FMT).alias("first_seen"), F.date_format("_last", FMT).alias("last_seen"))
    )


def retention_filter(df: DataFrame, ts_col: str, days: int) -> DataFrame:
    """LOG-08: keep rows within ``days`` of the newest timestamp.

    The newest timestamp is one global aggregate (a scalar subquery); the
    filter itself stays a narrow, pushed-down predicate.
    """
    newest = df.agg(F.max(ts_col).alias("_max"))
    return (df.join(F.broadcast(newest), F.lit(True))
            .where(F.col(ts_col) >= F.col("_max") - F.expr(f"INTERVAL {days} DAYS")).drop("_max"))
