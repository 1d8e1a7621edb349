"""Join helpers with explicit size checks.

``bounded_broadcast`` is the only place a side is broadcast on the strength
of a runtime row count; beyond the bound callers get a shuffle plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.session import BROADCAST_ROW_LIMIT


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT, bound: int | None = None) -> bool:
    """True when ``df`` has at most ``limit`` rows.

    ``bound`` is a known upper bound of the row count (for example the row
    count of the table ``df`` was filtered from, recorded when that table was
    written); when it is under the limit no job is needed. Otherwise the
    rows are counted: partial counts per task, one number each to the last.
    """
    if bound is not None and bound <= limit:
        return True
    return df.count() <= limit


#: Rows of a policy index that are sent to every task; each row holds one policy with lists of bounded length.
INDEX_ROW_LIMIT = 20_000


def sized_join(big: DataFrame, index: DataFrame, on: list[str], bound: int | None, how: str = "inner") -> DataFrame:
    """Join with a table of policies: a broadcast where ``bound``, a known number of rows, is under INDEX_ROW_LIMIT.

    Else a plain join, of which AQE makes a broadcast when the index turns out under the session's threshold of
    bytes, and splits the partitions of hot keys of ``big`` (``spark.sql.adaptive.skewJoin``) when not.
    """
    return big.join(F.broadcast(index) if bound is not None and bound <= INDEX_ROW_LIMIT else index, on, how)


def spread_join(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Join where a few keys of ``big`` may hold most of its rows and ``small`` is short.

    Rows of ``big`` are spread by a hash of the row, ``small`` is copied once for each core of the cluster, so no key
    is one task. No size is asked for; where ``small`` turns out tiny, AQE broadcasts it.
    """
    salts = max(2, big.sparkSession.sparkContext.defaultParallelism)
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return spread.join(copies, [*on, "_salt"]).drop("_salt")


def attach_each(big: DataFrame, small: DataFrame, limit: int = BROADCAST_ROW_LIMIT,
                buckets: int = 64, bound: int | None = None) -> DataFrame:
    """Pair every row of ``big`` with every row of a short ``small`` list.

    Used where the output is by definition big x small (each user gets every
    macro policy). Under the bound the small side is broadcast and the pairs
    are made inside each task. Beyond it, ``small`` is split into ``buckets``
    parts by hash, ``big`` is replicated once per part, and the pairs are made
    by an equi join on the part number, so no single task holds all of ``small``.
    """
    if fits_broadcast(small, limit, bound):
        return big.join(F.broadcast(small), F.lit(True))
    s = small.withColumn("_part", F.pmod(F.xxhash64(*small.columns), F.lit(buckets)))
    b = big.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, "_part").drop("_part")


def skew_safe_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                   salts: int | None = None, limit: int = BROADCAST_ROW_LIMIT, bound: int | None = None) -> DataFrame:
    """Join a large side whose keys may be very unequal (one key can hold a
    third of all rows) with a side that has one or few rows per key.

    Under the broadcast bound the small side is broadcast: no shuffle, no
    skew. Beyond it, the large side is spread by a salt taken from a hash of
    its whole row and the small side is copied once per salt value, so a hot
    key is split over ``salts`` tasks (None: as many as there are cores)
    instead of one.
    """
    if fits_broadcast(small, limit, bound):
        return big.join(F.broadcast(small), on, how)
    salts = salts or max(2, big.sparkSession.sparkContext.defaultParallelism)
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*on, "_salt"], how).drop("_salt")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row, however often filters and other columns read it.

    A generator of one row: a plain column would be written out again at every place that reads it.
    """
    return df.withColumn(name, F.explode(F.array(value)))
