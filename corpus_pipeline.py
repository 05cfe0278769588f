"""Training-corpus pipeline over ``documents``: quality rules, near-duplicate
removal, benchmark decontamination, redaction of personal data, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read back as the next stage's ``docs``. All stages but the last
return the columns of ``documents``. NULLs, empty texts, repeated rows and
empty tables are treated as the operators document it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import circulant_minhash, decontamination, mixing, pii_boosting, quality_divergence
from gleaner.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_divergence.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked on 5-word shingles at 0.8."""
    return circulant_minhash.keep_one(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the text."""
    return pii_boosting.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies`` and ``taken`` words."""
    return mixing.mix_sources(docs, keep_columns=True).filter("copies > 0")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal data", redacted),
    ("mixing", mixture),
]

ORACLE_SQL = None  # MinHash banding and boosted trees have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
