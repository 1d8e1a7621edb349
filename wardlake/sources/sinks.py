"""Writing the lake: overwrite tables, CTAS, keyed copies, per-owner landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table_overwrite(df: DataFrame, table: str, path: str, partition_by: list[str] | None = None) -> None:
    """SNK-01: overwrite an unmanaged Parquet table at ``path``."""
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def drop_if_exists(spark: SparkSession, table: str) -> None:
    """SNK-03."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def ctas_rollup(spark: SparkSession, table: str, path: str, select_sql: str) -> DataFrame:
    """SNK-02: drop, then create a Parquet table from a grouped query."""
    drop_if_exists(spark, table)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS {select_sql}")
    return spark.table(table)


def keep_latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """SNK-05: a row-keyed store keeps one row per key; the last write wins.

    ``max_by`` over a struct of the ordering columns picks the newest row per
    key in one sort aggregate (partial aggregation before the shuffle, so a hot
    key costs one row per map task, not its full group).
    """
    others = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def to_column_families(df: DataFrame, key: str, family: str) -> DataFrame:
    """SNK-06: ``:key,family:q1,family:q2...`` -> (key, family struct)."""
    quals = [c for c in df.columns if c != key]
    return df.select(F.col(key).alias("rowkey"), F.struct(*quals).alias(family))


def from_column_families(df: DataFrame, family: str, key_name: str) -> DataFrame:
    """SNK-06 inverse: flatten the family struct back to columns."""
    return df.select(F.col("rowkey").alias(key_name), f"{family}.*")


def land_per_owner(df: DataFrame, owner_col: str, path: str, fmt: str = "csv", rows_per_file: int = 1_000_000) -> None:
    """SNK-07: each owner gets a directory ``owner=<name>/`` (one write job).

    Rows are first shuffled by owner, so a directory is one file; only an owner
    with more than ``rows_per_file`` rows is spread by a salt over several tasks.
    Such owners are at most rows / ``rows_per_file``, so their list is short.
    A directory written by one task is moved into place whole when the job ends.
    """
    hot = df.groupBy(owner_col).count().where(F.col("count") > rows_per_file).select(
        F.col(owner_col).alias("_owner"), F.ceil(F.col("count") / rows_per_file).alias("_files"))
    salt = F.pmod(F.xxhash64(*df.columns), F.coalesce("_files", F.lit(1)))
    spread = (df.join(F.broadcast(hot), F.col(owner_col).eqNullSafe(F.col("_owner")), "left")
              .repartition(owner_col, salt).select(*df.columns))
    w = spread.write.mode("overwrite").partitionBy(owner_col)
    if fmt == "csv":
        w.option("sep", "\t").csv(path)
    else:
        w.parquet(path)
