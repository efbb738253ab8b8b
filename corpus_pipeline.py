"""From raw documents to token ids: each stage works on all that its predecessor kept and returns the columns of documents, but for the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stripeline.llm import decontaminate, mixing, simhash, tokenstore, toxicity
from stripeline.llm.common import stage, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to the target weights; each document is taken once at most, so near copies don't come back as epochs."""
    return mixing.rows_of(mixing.select(docs, mixing.Mix(max_epochs=1)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The content-addressed token store's summary, read from its files."""
    return tokenstore.token_store(docs)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("source_mixing", mixture),
    ("token_ids", token_ids),
]

#: The learned lexicon, the component search and the tokenizer have no SQL form; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
