"""From raw documents to packed sequences: quality rules, exact and near duplicates, source mixing, packing.

Each stage takes what its predecessor kept, written as Parquet and read again; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import exact_dedup, mixing, near_dedup, packing, quality
from wardlake.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the divergence from its language reject.

    A null text is empty and fails the base rules; a null language is a language of its own; repeated rows are judged
    alike; an empty table gives no rows.
    """
    return quality.good_documents(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest id of equal texts.

    A null text equals an empty one; a null id is the smallest; of rows that repeat id and text one stays.
    """
    return exact_dedup.distinct_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates; nulls and repeated rows as in ``near_dedup.classes``."""
    return near_dedup.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own; documents without words are not taken; a document taken n times is n rows.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids; a null text is its end id alone, repeated rows are packed each."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                     "sequence_id", "offset", "ids")


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_duplicates), ("near dedup", near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Near duplicates and dependent rounding are not expressible in SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
