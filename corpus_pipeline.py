"""A corpus from raw documents: stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontam, mixing, neardup, tokens, toxicity
from eventlake.llm.tables import stored, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the noisy-or model, learned from the labels, finds toxic."""
    return toxicity.drop_toxic(docs, toxicity.train_toxicity(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that each source's words come near its target."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the corpus as packed token ids and lists its documents, as read back."""
    return tokens.tokenized(docs)


STAGES = [("toxicity", toxic_out), ("near duplicates", one_of_each_group), ("decontamination", benchmark_out),
          ("mixing", mix_sources), ("tokens", token_files)]

ORACLE_SQL = None  # learned models and hashed draws have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
