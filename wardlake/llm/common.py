"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.session import cut_lineage

SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: read several times, computed once, safe from lost executors."""
    return cut_lineage(df, name=name)


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(col: str) -> Column:
    """A never-null join key for an id column (null ids share one key)."""
    return F.xxhash64(F.col(col))


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
                  salts: int = SALTS) -> DataFrame:
    """Attach a one-row-per-key table to rows whose keys may be very unequal.

    One key may hold a third of ``rows``: each row takes a salt from a hash of
    its own values and the lookup is copied once per salt, so that a hot key is
    spread over ``salts`` tasks. Rows must be narrow (no texts).
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


#: Links that one task joins to trees in its memory.
FOREST_LINKS = 250_000


def _forest(batches):
    """The links of one task as stars: every node with the least node that the task's links connect it to."""
    import pyarrow as pa
    up: dict[int, int] = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
    nodes = list(up)
    for k in range(0, len(nodes), 50_000):
        some = nodes[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([top(x) for x in some], pa.int64())],
                                         names=["node", "label"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, label) for each linked node.

    First every task turns at most about FOREST_LINKS links into stars, which keeps what they connect. If that
    took several tasks, rounds over all stars follow: a node takes the smallest label among its neighbours and
    then the label of that label, so a chain of n nodes needs about log n rounds. Labels are kept in written
    tables; only counts reach the driver. The rounds end when nothing changes.
    """
    parts = -(-max(1, links.count()) // FOREST_LINKS)
    stars = stage(links.select("a", "b").repartition(parts).mapInArrow(_forest, "node long, label long"), f"{name}-stars")
    if parts == 1:
        return stars
    far = stars.filter("node <> label").withColumnsRenamed({"node": "u", "label": "v"})
    both = far.unionByName(far.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    edges = stage(both, f"{name}-edges")
    labels = stage(edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label")), f"{name}-labels")
    while True:
        seen = salted_lookup(edges, labels.withColumnRenamed("node", "v"), ["v"], "inner")
        least = seen.groupBy("u").agg(F.min("label").alias("near")).withColumnRenamed("u", "node")
        lower = labels.join(least, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = stage(salted_lookup(lower, hop, ["label"], "inner").select(
            "node", "old", F.least("label", "far").alias("label")), f"{name}-labels")
        labels = new.select("node", "label")
        if new.filter("old <> label").limit(1).count() == 0:
            return labels
