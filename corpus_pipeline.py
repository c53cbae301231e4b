"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written as Parquet and read again, so a lost executor never costs more than a
stage. All stages but the last return the columns of ``documents``. Null or empty texts do
not pass the quality rules; the docstrings of the operators say what each does with ties,
repeated rows, empty tables and extra columns (they pass through).

1. quality rules: documents that fail the base rules or a cutoff go.
2. line dedup: lines of three or more documents stay in the last one only.
3. n-gram Jaccard join: one document of each group of near copies stays.
4. benchmark decontamination: documents that hold a benchmark passage go.
5. packing: windows of 2048 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.llm import decontam, jaccard, linededup, packing, quality
from corpuslink.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document keeps its row even if all its lines go; n_chars follows the text."""
    out = linededup.dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: Quality cutoffs, connected classes and packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
