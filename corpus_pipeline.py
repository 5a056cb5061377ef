"""Corpus pipeline: documents through the stages below, each read from the one before.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read back as the next
stage's ``docs``. All but the last return the columns of ``documents``; the
last returns one row per document of the token files it has written.

The stages aren't expressible in SQL as a whole (robust estimates, XXH64
fingerprints, a tokenizer), so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds ``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import common
from ledgerlake.llm.decontaminate import decontaminate
from ledgerlake.llm.mixing import mix_documents
from ledgerlake.llm.quality_rules import reject_outliers
from ledgerlake.llm.simhash import deduplicate
from ledgerlake.llm.token_output import token_output


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return reject_outliers(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with its smallest doc_id."""
    return deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat as often as the mix takes them; those it doesn't take go."""
    return mix_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row is encoded, written and read back."""
    return token_output(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs


ORACLE_SQL = None
