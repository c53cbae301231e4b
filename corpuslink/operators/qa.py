"""Search results joined with links, and question answering (O-53, O-72..O-74).

``hits`` is a search result: (verse_id, reference, text, score) with at most
k rows. Link lookups are one join for the whole result, not a query per hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.text import fmt_decimal, reference
from corpuslink.operators.embed import DEFAULT_DIM, encode
from corpuslink.operators.links import links_by_key, top_links_all
from corpuslink.operators.vector import topk_exact

# Fixed values of the reference's answer text.
NO_ANSWER = "No relevant verses found."
ANSWER_SEP = "\n\n"


def _hit_links(hits: DataFrame, edges: DataFrame, to_units: DataFrame, n: int) -> DataFrame:
    """Top ``n`` links of every hit, readable (AQE broadcasts the hits if they are small)."""
    ids = hits.select(F.col("verse_id").alias("from_id"))
    mine = edges.join(ids, "from_id", "left_semi")
    t = to_units.select(F.col("unit_id").alias("to_id"),
                        reference("book", "chapter", "verse").alias("to_ref"))
    return top_links_all(mine.join(t, "to_id"), n)


def search_with_links(hits: DataFrame, edges: DataFrame, to_units: DataFrame,
                      n_links: int = 5) -> DataFrame:
    """O-72: each hit with up to ``n_links`` (reference, votes); none -> empty list."""
    nested = links_by_key(_hit_links(hits, edges, to_units, n_links), "from_id",
                          ("to_ref", "votes"))
    empty = F.array().cast("array<struct<to_ref:string,votes:int>>")
    return (hits.join(nested.withColumnRenamed("from_id", "verse_id"), "verse_id", "left")
            .withColumn("links", F.coalesce("links", empty)))


def links_for(hits: DataFrame, edges: DataFrame, to_units: DataFrame, n: int = 5) -> DataFrame:
    """O-74: link references of a result set; hits without links are omitted."""
    top = _hit_links(hits, edges, to_units, n)
    return (top.join(hits.select(F.col("verse_id").alias("from_id"), "reference"), "from_id")
            .select("reference", "rank", "to_ref"))


def search_text_queries(units: DataFrame, queries: DataFrame, k: int = 10, *,
                        encoder=None, dim: int = DEFAULT_DIM, qid: str = "qid") -> DataFrame:
    """Text queries ``(qid, text)`` to the k nearest units ``(verse_id, text)``: both are
    encoded by the same encoder. Result: (qid, rank, verse_id, score)."""
    corpus = encode(units.select("verse_id", "text"), encoder, dim)
    asked = encode(queries.select(qid, "text"), encoder, dim).select(
        qid, F.col("vec").alias("qvec"))
    return topk_exact(corpus, asked, k, qid)


def ask(question: str, units: DataFrame, edges: DataFrame | None = None,
        to_units: DataFrame | None = None, *, k: int = 5, n_links: int = 5, encoder=None,
        dim: int = DEFAULT_DIM) -> DataFrame:
    """The main call: a question string to its answer row. ``units`` has verse_id,
    reference and text; the question is encoded like the units, searched, linked and
    answered."""
    asked = units.sparkSession.createDataFrame([(0, question)], "qid int, text string")
    top = search_text_queries(units, asked, k, encoder=encoder, dim=dim).where("score >= 0")
    hits = units.select("verse_id", "reference", "text").join(
        top.select("verse_id", "score"), "verse_id").select("verse_id", "reference", "text",
                                                            "score")
    return answer(question, hits, edges, to_units, n_links)


def answer(question: str, hits: DataFrame, edges: DataFrame | None = None,
           to_units: DataFrame | None = None, n_links: int = 5) -> DataFrame:
    """O-73: one row - numbered answer lines, mean score as confidence (O-53),
    ``num_verses``, and a map reference -> link references for hits with links.

    Empty result: the fixed message, confidence 0.0, ``num_verses`` NULL.
    """
    # The answer is one text of all hits, so they meet in one row by definition.
    hit = F.struct((-F.col("score")).alias("s"), "verse_id", "reference", "text",
                   fmt_decimal("score", 2).alias("r"))
    line = F.transform(F.array_sort(F.collect_list(hit)), lambda h, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), h["reference"], F.lit(': "'), h["text"],
        F.lit('" (relevance: '), h["r"], F.lit(")")))
    agg = hits.agg(F.array_join(line, ANSWER_SEP).alias("_answer"),
                   F.avg("score").alias("_conf"), F.count(F.lit(1)).alias("_n"))
    out = agg.select(
        F.lit(question).alias("question"),
        F.when(F.col("_n") == 0, F.lit(NO_ANSWER)).otherwise(F.col("_answer")).alias("answer"),
        F.coalesce(F.col("_conf"), F.lit(0.0)).alias("confidence"),
        F.when(F.col("_n") > 0, F.col("_n")).alias("num_verses"))
    if edges is None:
        return out
    lf = links_for(hits, edges, to_units, n_links)
    refs = (lf.groupBy("reference")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "to_ref"))).alias("_l"))
            .select(F.struct("reference", F.transform("_l", lambda s: s["to_ref"])).alias("_e")))
    m = refs.agg(F.map_from_entries(F.collect_list("_e"))).scalar()  # one row (<= k entries)
    return out.withColumn("cross_references", m)
