"""Retail rollups (sales by sku/category), limits, top-k and latest-by-glob."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions.globs import glob_to_regex
from wardlake.operators.joins import sized_join

# Money is summed as DECIMAL(38,2): exact, so the order of addition across
# tasks never changes a cent.
MONEY = "decimal(38,2)"


def money_sum(c: str):
    return F.sum(F.col(c).cast(MONEY))


def sales_by_sku(orders: DataFrame, products: DataFrame) -> DataFrame:
    """JN-01 + AGG-01: sum(price) per (sku, product_category).

    Orders are pre-aggregated per ``sku`` first (partial + final aggregate),
    so the join with products sees one row per sku instead of one per order
    line; the final group by keeps the result equal to join-then-aggregate
    even if products held a sku twice.
    """
    o = orders.groupBy("sku").agg(money_sum("price").alias("_s"))
    p = products.select("sku", "product_category")
    return (
        o.join(p, "sku", "inner")
        .groupBy("sku", "product_category")
        .agg(F.sum("_s").cast("double").alias("total_sales"))
        .select("total_sales", "sku", "product_category")
    )


def sales_by_category(sales: DataFrame) -> DataFrame:
    """AGG-02 + SRT-01: sum(total_sales) per category, largest first."""
    return (
        sales.groupBy("product_category")
        .agg(money_sum("total_sales").cast("double").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "product_category")
    )


def limit_n(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """LIM-01: the first ``n`` rows; ordered by a full key so any run agrees."""
    return df.orderBy(*order_cols).limit(n)


def peek(df: DataFrame, n: int = 2) -> list:
    """LIM-03: first rows for display (``take`` reads only what it needs)."""
    return df.take(n)


def top_k(df: DataFrame, k: int, by: str, tie: list[str]) -> DataFrame:
    """LIM-02: order + limit plans as TakeOrderedAndProject (per-task heaps)."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def latest_matching(items: DataFrame, requests: DataFrame, name_col: str, order_cols: list[str],
                    label_col: str = "label", glob_col: str = "glob", bound: int | None = None) -> DataFrame:
    """LIM-04: newest item whose name fits a glob, per requested label.

    Items of one name are first reduced to the newest, partial before the shuffle. A glob is found under the literal
    text before its first wildcard, which is a prefix of every name that fits, so names meet their globs by an equi
    join and a regex tests only these pairs. ``bound``: a known number of requests, which are broadcast where it is
    small (``joins.sized_join``). Several globs of one label count together.
    """
    newest = F.max_by(F.struct("*"), F.struct(*[F.col(c) for c in order_cols]))
    names = items.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("_name")).agg(newest.alias("_r"))
    reqs = requests.select(F.col(label_col).alias("_label"), glob_to_regex(F.col(glob_col)).alias("_re"),
                           F.regexp_extract(glob_col, r"^([^*?]*)", 1).alias("_prefix"))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("_name")), lambda k: F.substr("_name", F.lit(1), k))
    met = sized_join(names.withColumn("_prefix", F.explode(prefixes)), reqs, ["_prefix"], bound)
    order = F.struct(*[F.col(f"_r.{c}") for c in order_cols])
    return met.where(F.regexp_like("_name", F.col("_re"))).groupBy("_label").agg(
        F.max_by("_r", order).alias("_r")).select(F.col("_label").alias(label_col), "_r.*")
