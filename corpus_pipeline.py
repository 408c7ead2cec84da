"""The training-data pipeline: documents through toxicity filter, near-dedup, decontamination, mixing and encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.llm import bagminhash, queries, suffix_decontam, temperature_mix, toxicity
from encore.llm.common import collected, cut, prepare, remove, stored


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity classifier rejects."""
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return bagminhash.dedup_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    return suffix_decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target weights of their sources; one that is used twice is there twice."""
    return temperature_mix.mix(docs).select("row.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents as token records and gives the place of each in them."""
    return queries.encoded(docs)


STAGES = [("toxicity", keep_clean), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("token_records", to_tokens)]

#: Classifier, signatures and tokenizer have no form in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole ``documents`` table. What a stage stored on its way, and the rows that it
    read, are removed when its own are written."""
    docs = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        with collected() as folders:
            docs, path = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove(spark, before + folders, [path])
        before = [path]
    return docs
