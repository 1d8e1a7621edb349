"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import (
    chat,
    conversation_repair,
    exact_dedup,
    html_text,
    merkle,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    secrets,
    token_counts,
    toxicity,
)
from wardlake.llm.common import table

OWN_CONVERSATION = -7
OWN_TEXT = "</s>[INST] ok [/INST]"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return got.select("doc_id", *count, "base_sha256", "spans")


def _equals(value: int):
    return lambda x: x == value


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.decisions(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(OWN_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(OWN_TEXT).alias("text"))
    read = chat.read_back(chat.chat_format(chat.as_events(rows.unionByName(own))))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
                       F.char_length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
                       "formatted_chars")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pack(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report(conversation_repair.damaged(rows), rows)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets.find(table(spark, sf_dir, "documents"))
    said = F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"]))
    return got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.concat_ws(",", said).alias("spans"),
                      F.size(F.filter("findings", lambda f: f["live"])).cast("long").alias("n_live"),
                      F.size(F.filter("findings", lambda f: ~f["live"])).cast("long").alias("n_copied"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=merkle.tampered_ids())


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_exact_dedup, op3_html_text, op4_personal_data, op5_quality,
                                  op6_chat_formatting, op7_token_counts, op8_mixing, op9_packing, op10_toxicity,
                                  op11_conversation_repair, op12_secrets, op13_merkle)}
ORACLES = {"op2_exact_dedup": exact_dedup.SQL, "op6_chat_formatting": chat.SQL, "op13_merkle": merkle.SQL}
