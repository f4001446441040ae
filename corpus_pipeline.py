"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before has kept, and returns a DataFrame;
all but the last return the columns of documents. `run` writes each stage's result to the shared folder and reads it
again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varzea.llm.common import materialize, table
from varzea.llm.decontamination import decontaminate
from varzea.llm.mixing import apply_mix
from varzea.llm.quality_rules import keep_good
from varzea.llm.simhash import keep_one
from varzea.llm.suffix_dedup import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (Jaccard similarity of 5-word shingles of 0.8 or more) stays."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too are cut out."""
    return without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the rates that bring the domains' words to their targets."""
    return apply_mix(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("mixing", mixing),
]

#: the fingerprints, the suffix ranks and the fitted rates are not expressible in DuckDB; tests/llm has brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
