"""The corpus under SQL names (O-35, O-36, O-40): tables, two views and a table function.

After ``register_corpus`` plain ``spark.sql`` text works on ``verses``, ``books`` and ``links``, on
``verse_view`` (a verse with its book), on ``link_view`` (a link with both ends readable) and
on ``top_links(book, chapter, verse, k)``, the k links of a verse with the most votes. Any of them can
be given another name, so SQL written for other names runs as it stands. Everything is temporary
to the session and planned by Catalyst with the query that uses it: filters on a view's columns
reach the scans, unused joins and columns go. A view has no order of its own (an ORDER BY
belongs to the query).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.query import units_view

NAMES = ("verses", "books", "links", "verse_view", "link_view", "top_links")

# Ties go to the lower target id (D3); the window sees one verse's links.
TOP_LINKS = """
CREATE OR REPLACE TEMPORARY FUNCTION {top_links}(
  of_book STRING, of_chapter BIGINT, of_verse BIGINT, k INT DEFAULT 5)
RETURNS TABLE (to_book STRING, to_chapter BIGINT, to_verse BIGINT, votes INT, rank INT)
RETURN SELECT to_book, to_chapter, to_verse, votes, rank FROM (
  SELECT to_book, to_chapter, to_verse, votes, CAST(row_number() OVER (
           PARTITION BY from_verse_id ORDER BY votes DESC, to_verse_id) AS INT) AS rank
  FROM {link_view}
  WHERE from_book = of_book AND from_chapter = of_chapter AND from_verse = of_verse)
WHERE rank <= k
"""


def readable_links(links: DataFrame, units: DataFrame) -> DataFrame:
    """Links with both ends as (book, chapter, verse), besides their ids."""
    out = links
    for side in ("from", "to"):
        out = out.join(units.select(
            F.col("verse_id").alias(f"{side}_verse_id"), F.col("book_name").alias(f"{side}_book"),
            F.col("chapter").alias(f"{side}_chapter"), F.col("verse").alias(f"{side}_verse")),
            f"{side}_verse_id")
    return out


def register_corpus(spark: SparkSession, books: DataFrame, verses: DataFrame, links: DataFrame,
                    names: dict[str, str] | None = None) -> dict[str, str]:
    """Register ``books(book_id, book_number, book_name, testament)``, ``verses(verse_id, book_id,
    chapter, verse, text)`` and ``links(from_verse_id, to_verse_id, votes)``; returns the names in
    use. ``names`` renames any of ``NAMES``."""
    unknown = set(names or {}) - set(NAMES)
    if unknown:
        raise ValueError(f"no such tables, views or functions: {sorted(unknown)}")
    used = {n: n for n in NAMES} | (names or {})
    units = units_view(verses, books)
    for name, table in (("verses", verses), ("books", books), ("links", links),
                        ("verse_view", units), ("link_view", readable_links(links, units))):
        table.createOrReplaceTempView(used[name])
    spark.sql(TOP_LINKS.format(**used))
    return used
