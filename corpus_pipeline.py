"""A training-corpus pipeline: five operators in a row, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a frame that ``run`` writes as Parquet to
the cluster's shared folder and rereads as the next one's docs, which cuts the lineage. All
but the last return the columns of docs.

* language_id drops documents without any recognisable language (``und``: no letter); where no
  language can be learned, those without a letter.
* simhash_near_dedup keeps the document with the smallest id of each near-duplicate class.
* decontaminate drops documents in which a benchmark item occurs.
* personal_data replaces every span of personal data by its kind and restates n_chars.
* mix_sources states how many words the mix takes from each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystick.llm import decontaminate as decontamination
from tallystick.llm import language_id as languages
from tallystick.llm import mixing, pii, simhash_dedup
from tallystick.llm.common import table
from tallystick.sources.workspace import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = languages.train(docs)
    if model is None:
        return docs.where(languages.lettered(F.col("text")))
    lang = languages.predicted(F.col("text"), model).getField("lang")
    return docs.where(lang != languages.UNKNOWN)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = docs.withColumn("text", pii.redacted(F.col("text"), pii.train(docs)))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
]

# Trained models and SimHash cannot be written in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
