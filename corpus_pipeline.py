"""A training corpus from documents: toxic documents go, one of each group of near duplicates stays, contaminated documents go, personal
data is masked, and the sources are mixed to their target weights. Each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from capturebase.llm import decontaminate, mixing, ngram_join, pii, toxicity
from capturebase.llm._store import Store


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_duplicates(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that reach it, text included, with the copies of each: 0 for those that the mixture leaves out."""
    return mixing.draw(docs)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", contaminated), ("personal_data", personal_data), ("mixing", mixed)]

#: No stage but the third could be said in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training corpus: the chosen documents with their columns and copies; every stage is written as Parquet and read by the next. What a
    stage and its operator have written for themselves goes when the next stage has what it needs."""
    store, docs = Store(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        since = len(Store.opened)
        docs = store.put(stage(spark, docs, sf_dir), name)
        Store.sweep(since)
        if k:
            store.drop(STAGES[k - 1][0])
    return docs.where("copies > 0")
