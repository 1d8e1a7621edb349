"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Texts are equal when identical (null counts as empty). Every stage groups by
the digest *and* the whole text, so equal means equal content:

1. each task combines its own rows (the partial aggregate), and the copies of a
   text meet by (digest, salt), the salt taken from the document id, so that a
   text that a third of all rows share is merged by many tasks;
2. the winners of the salts, at most one row per text and salt, are combined
   per text over the whole table;
3. what a group decided goes back to its rows by the digest alone, which is
   enough where a digest has one text. A digest with several texts (never seen
   for SHA-256, usual for the weak digests of the tests) goes back by digest
   and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlake.llm.common import SALTS, row_key, salted_lookup, stage, text_of


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
              digest=sha256_hex) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the largest id among rows of the same text (null when all ids
    of the group are null; a null id loses to any other), group_size counts its
    rows. Exactly one row of a group is kept: of rows that repeat both id and
    text, one. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    keyed = rows.withColumn("digest", digest(F.col("text")))
    salted = keyed.withColumn("salt", F.pmod(row_key("doc_id"), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("id"), F.count("*").alias("n"))
    winners = merged.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    groups = stage(winners.groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")),
        "exact-groups")
    lookup = groups.filter("texts = 1 AND group_size > 1").select("digest", "keep_id", "group_size")
    mixed = groups.filter("texts > 1").select("digest")
    found = salted_lookup(keyed.select("doc_id", "digest", F.sha2("text", 256).alias("text_sha256")), lookup, ["digest"])
    if mixed.limit(1).count():
        own = keyed.join(mixed, "digest").withColumn("text_sha256", F.sha2("text", 256))
        by_text = own.join(winners.join(mixed, "digest"), ["digest", "text"])
        found = found.join(mixed, "digest", "left_anti").unionByName(by_text.select(found.columns))
    found = found.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(
        F.col("keep_id"))).withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
    again = F.row_number().over(W.partitionBy("text_sha256", "doc_id").orderBy(F.lit(0)))
    return found.select("doc_id", "keep_id", "group_size",
                        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (again == 1)).alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``decisions`` drops, all columns as they were, whatever their names.

    Nulls, ties and repeated rows are decided as there: of equal texts the row with the largest id stays, of rows that
    repeat id and text one; an empty table gives no rows.
    """
    kept = decisions(docs, id_col, text_col).filter("kept").select(row_key("doc_id").alias("key"), F.col("text_sha256").alias("digest"))
    return rows_of(docs, kept, id_col, text_col)


def rows_of(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (key of the id, digest of the text) is in ``kept``, one for each."""
    # a row travels as one column, so its own column names can clash with none of these
    keyed = docs.select(F.struct("*").alias("row"), row_key(id_col).alias("key"), F.sha2(text_of(text_col), 256).alias("digest"))
    stay = keyed.join(kept, ["key", "digest"], "left_semi")
    again = F.row_number().over(W.partitionBy("key", "digest").orderBy("key", "digest"))
    return stay.withColumn("again", again).filter("again = 1").select("row.*")


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
