"""Corpus pipeline: toxicity, near-duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame that is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import stage, table

# No SQL: the toxicity model is not expressible; tests compare with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (score of 0.7 or more) go."""
    from ledgerscope.llm.toxicity import drop_toxic
    return drop_toxic(docs, docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    from ledgerscope.llm.simhash import keep_one
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule marks go."""
    from ledgerscope.llm.decontaminate import decontaminate
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    from ledgerscope.llm.secrets import redact
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, range-sorted by first training position,
    with size, source_size, target, taken and the copies' positions."""
    from ledgerscope.llm.mixing import mix
    mixed = mix(docs).filter("taken > 0")
    return mixed.withColumn("position", F.get("copies", F.lit(0))["position"]).orderBy("position", "doc_id")


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secrets), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
