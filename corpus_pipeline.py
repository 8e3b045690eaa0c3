"""The corpus pipeline: five stages over ``documents``, each an operator of ``comms_lake.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept; its result is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comms_lake.llm import bpe, decontam, exact_dedup, langid, simhash
from comms_lake.llm.common import table
from comms_lake.llm.queries import language_rows
from comms_lake.session import run_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the model learns from the labelled rows of its own input."""
    return langid.keep_known(spark, docs, langid.learn(spark, language_rows(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, two bits)."""
    return simhash.keep_one(spark, docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    return decontam.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes per document."""
    return bpe.digests(docs, bpe.Tokenizer(spark))


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", decontaminated), ("BPE encoding", encoded)]

# A fingerprint of XXH64 hashes, a trained model and BPE are not SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written and reread."""
    docs, root = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/stage={number}")
        docs = spark.read.parquet(f"{root}/stage={number}")
    return STAGES[-1][1](spark, docs, sf_dir)
