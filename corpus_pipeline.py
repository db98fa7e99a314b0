"""From raw documents to a training mix: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the documents are
written as Parquet in the shared folder and read again. Rows with nulls, repeated rows and empty tables are treated as
the operators say; a document that line dedup leaves without a word goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontamination, line_dedup, mixing, near_dup, quality, rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.judge(docs).where("kept").select("row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; documents that keep no word go."""
    found = line_dedup.remove(docs).where(F.regexp_like("kept", F.lit(rows.WORD)))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*(new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.clean(docs, rows.table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, with the number of the copy."""
    return mixing.emit(mixing.plan(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("mixing", source_mix),
]

# Alignment, sketches and expectation-maximisation have no SQL form; the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = rows.cut(docs)
    return docs
