"""Governed read (GOV-09/10/11): column ACL, row filter and masks in one plan.

``governed(...)`` resolves, for one (user, table), the few policy rows that
concern it — a bounded set: a handful of items per column — on the driver,
then returns an ordinary DataFrame: the row filter on the *raw* columns
(pushed to the scan by Catalyst), then the masked projection of the allowed
columns. A user's own filters go on top, so they see masked values.

Unlike a plan-rewriting extension this is opt-in: it protects reads made
through it and does not stop a direct read of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions.masks import custom_value, mask_column
from wardlake.operators import access
from wardlake.operators.matching import match_index


class AccessDenied(PermissionError):
    pass


LEVELS = {"database": "db", "table": "tbl", "column": "col"}


def resolve_policies(spark: SparkSession, user: str, db: str, tbl: str, columns: list[str], index: DataFrame,
                     who: DataFrame, long_items: DataFrame | None = None,
                     bound: int | None = None) -> tuple[set[str], str | None, dict[str, tuple]]:
    """(columns that may be selected, row filter, column -> (mask type, value, condition)).

    The table (a key without a column) and its columns meet the policy index once, with access, filter and mask items
    in one row; one row per column comes back. Of filters and masks the first fitting item counts, by policy id, then
    order.
    """
    keys = spark.createDataFrame([(user, "select", db, tbl, c) for c in [None, *columns]],
                                 "user string, access string, db string, tbl string, col string")
    met = access.with_principals(match_index(keys, LEVELS, index, bound), who, long_items)
    its = F.filter("its", lambda x: x["access"] == F.col("access"))
    of = lambda k: F.transform(F.filter("its", lambda x: x["kind"] == k), lambda x: x["principal"])
    entry = F.struct("policy_id", "priority", "deny_all_else", "is_audit_enabled", *[of(k).alias(k) for k in access.ACCESS_KINDS])

    def first(kind, fields):
        fit = F.filter("its", lambda x: (x["kind"] == kind) & F.array_contains("who", x["principal"]))
        return F.min(F.array_min(F.transform(fit, lambda x: F.struct(
            F.col("policy_id"), x["item_no"].alias("item_no"), *[x[c].alias(c) for c in fields]))))

    decides = (F.col("policy_type") == 0) & ((F.size("its") > 0) | F.col("deny_all_else"))
    rows = (met.withColumn("its", its).groupBy("user", "col").agg(
        F.collect_list(F.when(decides, entry)).alias("policies"), F.first("who").alias("tags"), F.first("held").alias("lists"),
        first("mask", ["mask_type", "value_expr", "condition_expr"]).alias("mask"),
        first("row_filter", ["filter_expr"]).alias("filter"))
        .withColumnsRenamed({"tags": "who", "lists": "held"}).select("col", access.verdict(access.judge(F.col("policies")))["decision"].alias("decision"), "mask", "filter").collect())
    row_filter = next((r["filter"]["filter_expr"] for r in rows if r["col"] is None and r["filter"]), None)
    masks = {r["col"]: (r["mask"]["mask_type"], r["mask"]["value_expr"], r["mask"]["condition_expr"])
             for r in rows if r["col"] is not None and r["mask"]}
    return {r["col"] for r in rows if r["decision"] == "ALLOW" and r["col"] is not None}, row_filter, masks


def check_expr(df: DataFrame, text: str) -> None:
    """An expression held as data must analyse against the table and hold no subquery."""
    spark = df.sparkSession
    parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    if spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression.hasSubquery(parsed):
        raise ValueError(f"policy expression rejected (subquery): {text!r}")
    df.select(F.expr(text)).schema  # analysis only; raises on unknown columns


def apply_row_filter(df: DataFrame, expr: str | None) -> DataFrame:
    if not expr:
        return df
    check_expr(df, expr)
    return df.where(F.expr(expr))


def apply_masks(df: DataFrame, masks: dict[str, tuple], keep: list[str] | None = None) -> DataFrame:
    cols = keep if keep is not None else df.columns
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for c in cols:
        kind, value, condition = (*masks.get(c, ()), None, None, None)[:3]
        for text in (custom_value(c, value) if kind == "CUSTOM" and value else None, condition):
            if text:
                check_expr(df, text)
    return df.select(*[mask_column(c, types[c], *masks.get(c, (None, None))) for c in cols])


def governed(df: DataFrame, user: str, db: str, tbl: str, index: DataFrame, who: DataFrame,
             long_items: DataFrame | None = None, bound: int | None = None, row_filter: bool = True, masks: bool = True,
             column_acl: bool = True, denied: str = "drop") -> DataFrame:
    """The table as ``user`` may see it. ``index``: the policies of its service (``access.policy_index``).

    Columns the user may not select are dropped (``denied="drop"``, the
    default) or kept as typed NULLs (``denied="null"``, a stable schema for
    reports that run for many readers).
    """
    allowed, rows, found = resolve_policies(df.sparkSession, user, db, tbl, df.columns, index, who, long_items, bound)
    keep, m = df.columns, dict(found) if masks else {}
    if column_acl:
        keep = [c for c in df.columns if c in allowed]
        if not keep:
            raise AccessDenied(f"{user} may not select from {db}.{tbl}")
        if denied == "null":
            m.update({c: ("MASK_NULL", None, None) for c in df.columns if c not in allowed})
            keep = df.columns
    return apply_masks(apply_row_filter(df, rows) if row_filter else df, m, keep)
