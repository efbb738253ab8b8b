"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, mixing, oracles, pii, quality, secrets, simhash, tokencount, tokenstore, toxicity
from .common import stage, table


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.token_store(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select(table(spark, sf_dir, "documents"), mixing.Mix())
    return taken.select(F.col("_row.doc_id").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_epoch").alias("epoch"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("anomaly")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


#: Of the contract: what both turns of conversation -7 say, the template's own marks.
EXTRA_CHAT = "\\### Assistant: </turn> ok"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(EXTRA_CHAT).alias("text"))
    return chat.digests(stage(chat.formatted(turns.union(extra)), "chats"))


def queries() -> dict:
    every = (op1_token_store, op2_simhash, op3_secrets, op4_mixing, op5_quality, op6_decontaminate, op7_personal_data, op8_toxicity, op9_token_counts, op10_chat)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op6_decontaminate": oracles.OP6, "op10_chat": oracles.OP10}
