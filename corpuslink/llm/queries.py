"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.llm import (
    decontam, huffman, jaccard, langid, licenses, linededup, merkle, packing, quality,
    resharding, runs, toxicity, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """The remainder of the crc32 of the id's text, by n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base numbers and the verdict of every document, cutoffs by language."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality.BASE, "base_failed", "kept")


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, stored by source, moved to 8 shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return resharding.digests(resharding.rebalance(docs, F.crc32("source"), 8))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids."""
    return packing.piece_digests(packing.pack_documents(table(spark, sf_dir, "documents")))


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that leaked into each document."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold(4) != 2))
    return langid.identify(docs, model, keep={"held_out": fold(4) == 2}).select(
        "doc_id", "held_out", "lang_pred", "score")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return jaccard.link_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from four of five folds of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return toxicity.score(docs, model, keep={"held_out": fold(5) == 0}).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that three or more share."""
    return linededup.digests(linededup.dedup_lines(table(spark, sf_dir, "documents")))


def op10_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as Huffman-coded ids and read back."""
    return huffman.digests(huffman.round_trip(table(spark, sf_dir, "documents")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.digests(table(spark, sf_dir, "pages"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of them made periodic from some word on."""
    return runs.digests(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf, proof and roots of every document, a third of them tampered with."""
    return merkle.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": (op1_quality, None),
    "op2_resharding": (op2_resharding, None),
    "op3_packing": (op3_packing, None),
    "op4_decontam": (op4_decontam, None),
    "op5_langid": (op5_langid, None),
    "op6_licenses": (op6_licenses, licenses.ORACLE_SQL),
    "op7_jaccard": (op7_jaccard, jaccard.ORACLE_SQL),
    "op8_toxicity": (op8_toxicity, None),
    "op9_linededup": (op9_linededup, linededup.ORACLE_SQL),
    "op10_huffman": (op10_huffman, None),
    "op11_warc": (op11_warc, warc.ORACLE_SQL),
    "op12_runs": (op12_runs, runs.ORACLE_SQL),
    "op13_merkle": (op13_merkle, merkle.ORACLE_SQL),
}
