"""The demo queries as SQL text over registered views (O-35, O-36, O-40, O-44..O-47).

One corpus for both ends of the links: orders and parts are verses (ids ``2 * key`` and
``2 * key + 1``), their priorities and brands the books, line items the links (first wins).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.operators.sql_views import register_corpus
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import EDGES, with_

CORPUS = """
books AS (
  SELECT 'o' || o_orderpriority AS book_id, o_orderpriority AS book_name, 'Old' AS testament,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS book_number FROM orders GROUP BY ALL
  UNION ALL SELECT 'p' || p_brand, p_brand, 'New', CAST(substr(p_brand, 7) AS INTEGER) + 100
  FROM part GROUP BY ALL),
verses AS (
  SELECT o_orderkey * 2 AS verse_id, 'o' || o_orderpriority AS book_id, o_custkey AS chapter,
         o_orderkey AS verse, 'Order of ' || o_custkey AS text FROM orders
  UNION ALL SELECT p_partkey * 2 + 1, 'p' || p_brand, CAST(p_size AS BIGINT), p_partkey,
                   'Part of size ' || p_size FROM part),
vv AS (SELECT * FROM verses JOIN books USING (book_id)),
lv AS (
  SELECT f.book_name AS from_book, f.chapter AS from_chapter, f.verse AS from_verse,
         t.book_name AS to_book, t.chapter AS to_chapter, t.verse AS to_verse, votes, to_id,
         row_number() OVER (PARTITION BY from_id ORDER BY votes DESC, to_id) AS r
  FROM edges JOIN vv f ON f.verse_id = from_id * 2 JOIN vv t ON t.verse_id = to_id * 2 + 1)
"""
BRAND = "(SELECT min(p_brand) FROM part)"


def corpus(spark, sf_dir):
    o, p = S.table(spark, sf_dir, "orders"), S.table(spark, sf_dir, "part")
    books = o.select(
        F.concat(F.lit("o"), "o_orderpriority").alias("book_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("book_number"),
        F.col("o_orderpriority").alias("book_name"), F.lit("Old").alias("testament")).union(p.select(
            F.concat(F.lit("p"), "p_brand"), F.substring("p_brand", 7, 9).cast("int") + 100,
            "p_brand", F.lit("New"))).distinct()
    verses = o.select(
        (F.col("o_orderkey") * 2).alias("verse_id"), F.concat(F.lit("o"), "o_orderpriority").alias(
            "book_id"), F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("verse"),
        F.concat(F.lit("Order of "), F.col("o_custkey").cast("string")).alias("text")).union(p.select(
            F.col("p_partkey") * 2 + 1, F.concat(F.lit("p"), "p_brand"), F.col("p_size").cast("long"),
            "p_partkey", F.concat(F.lit("Part of size "), F.col("p_size").cast("string"))))
    links = S.link_edges(spark, sf_dir).select(
        (F.col("from_id") * 2).alias("from_verse_id"), (F.col("to_id") * 2 + 1).alias("to_verse_id"),
        "votes")
    register_corpus(spark, books, verses, links)
    return spark


@register("sql_chapter_lookup", oracle=with_(EDGES, CORPUS) + f"""
SELECT 'verse' AS asked, book_name, testament, chapter, verse, text FROM vv
WHERE book_name = {BRAND} AND chapter = 1 AND verse = (SELECT min(verse) FROM vv
                                                       WHERE book_name = {BRAND} AND chapter = 1)
UNION ALL (SELECT 'chapter', book_name, testament, chapter, verse, text FROM vv
           WHERE testament = 'New' AND chapter = 7 ORDER BY book_number, verse LIMIT 3)
UNION ALL (SELECT 'search', book_name, testament, chapter, verse, text FROM vv
           WHERE text LIKE '%size 4%' ORDER BY book_number, chapter, verse LIMIT 5)
""")
def q_sql_chapter_lookup(spark, sf_dir):
    """O-35, O-37..O-39 as SQL text: a verse, a chapter's head, a search, over the verse view."""
    brand = "(SELECT min(book_name) FROM books WHERE testament = 'New')"
    return corpus(spark, sf_dir).sql(f"""
        SELECT 'verse' AS asked, book_name, testament, chapter, verse, text FROM verse_view
        WHERE book_name = {brand} AND chapter = 1 AND verse = (
          SELECT min(verse) FROM verse_view WHERE book_name = {brand} AND chapter = 1)
        UNION ALL (SELECT 'chapter', book_name, testament, chapter, verse, text FROM verse_view
                   WHERE testament = 'New' AND chapter = 7 ORDER BY book_number, verse LIMIT 3)
        UNION ALL (SELECT 'search', book_name, testament, chapter, verse, text FROM verse_view
                   WHERE text LIKE '%size 4%' ORDER BY book_number, chapter, verse LIMIT 5)""")


@register("sql_links_view", oracle=with_(EDGES, CORPUS) + """
SELECT from_book, to_book, count(*) AS n_links, sum(votes)::BIGINT AS votes, max(votes) AS most
FROM lv GROUP BY from_book, to_book
""")
def q_sql_links_view(spark, sf_dir):
    """O-36 as SQL text: the readable link view grouped by its books."""
    return corpus(spark, sf_dir).sql("""
        SELECT from_book, to_book, count(*) AS n_links, sum(votes) AS votes, max(votes) AS most
        FROM link_view GROUP BY from_book, to_book""")


@register("sql_top_links", oracle=with_(EDGES, CORPUS) + """
SELECT from_book AS book_name, from_chapter AS chapter, from_verse AS verse, CAST(r AS INTEGER) AS rank,
       to_book, to_chapter, to_verse, votes
FROM lv WHERE r <= 3 AND from_book = '1-URGENT'
""")
def q_sql_top_links(spark, sf_dir):
    """O-40 as SQL text: the table function, called for every verse of a book."""
    return corpus(spark, sf_dir).sql("""
        SELECT v.book_name, v.chapter, v.verse, t.rank, t.to_book, t.to_chapter, t.to_verse, t.votes
        FROM verse_view v, LATERAL top_links(v.book_name, v.chapter, v.verse, 3) t
        WHERE v.book_name = '1-URGENT'""")


@register("sql_statistics", oracle=with_(EDGES, CORPUS) + """
SELECT (SELECT count(*) FROM books) AS n_books, (SELECT count(*) FROM verses) AS n_verses,
       (SELECT count(*) FROM edges) AS n_links,
       (SELECT count(*) FROM vv WHERE testament = 'Old') AS n_old,
       (SELECT book_name FROM vv GROUP BY book_name ORDER BY count(*) DESC, book_name LIMIT 1)
         AS largest
""")
def q_sql_statistics(spark, sf_dir):
    """O-44, O-46, O-47 as SQL text over the registered tables."""
    return corpus(spark, sf_dir).sql("""
        SELECT (SELECT count(*) FROM books) AS n_books, (SELECT count(*) FROM verses) AS n_verses,
               (SELECT count(*) FROM links) AS n_links,
               (SELECT count(v.verse_id) FROM verses v JOIN books b ON v.book_id = b.book_id
                WHERE b.testament = 'Old') AS n_old,
               (SELECT first(book_name) FROM (
                  SELECT b.book_name, count(v.verse_id) AS n FROM verses v
                  JOIN books b ON v.book_id = b.book_id GROUP BY b.book_name
                  ORDER BY n DESC, b.book_name LIMIT 1)) AS largest""")
