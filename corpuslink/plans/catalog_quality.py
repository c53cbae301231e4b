"""Audit queries (O-55..O-59) over a customer x month grid of ``orders``, and
verse holes (O-58) over document lines.

Stand-in: group = customer, chapter = month index since the first order month
of the whole table, expected = the index of the last month.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.operators import quality as QA
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import UNITS, with_

GRID_SQL = """
WITH o AS (SELECT o_custkey AS key, year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders),
b AS (SELECT min(m) AS lo, max(m) AS hi FROM o),
u AS (SELECT key, CAST(m - lo + 1 AS INTEGER) AS chapter FROM o, b),
bk AS (SELECT c_custkey AS key, CAST(hi - lo + 1 AS INTEGER) AS expected FROM customer, b)
"""


def grid(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("_m"))
    # Global bounds are one-row aggregates, attached as scalar subqueries.
    lo = o.agg(F.min("_m")).scalar()
    hi = o.agg(F.max("_m")).scalar()
    units = o.select("key", (F.col("_m") - lo + 1).alias("chapter"))
    books = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"),
                                                     (hi - lo + 1).alias("expected"))
    return books, units


@register("missing_keys", oracle=GRID_SQL + """
SELECT key FROM (SELECT key + 7 AS key FROM bk) WHERE key NOT IN (SELECT key FROM u)
""")
def q_missing_keys(spark, sf_dir):
    """O-55: expected groups (customer keys plus 7, so that some are beyond the last
    customer) without any order."""
    books, units = grid(spark, sf_dir)
    return QA.missing_books(books.withColumn("key", F.col("key") + 7), units).select("key")


@register("mismatch", oracle=GRID_SQL + """
SELECT u.key, max(u.chapter) AS max_chapter, bk.expected FROM u JOIN bk ON bk.key = u.key
GROUP BY u.key, bk.expected HAVING max(u.chapter) <> bk.expected
""")
def q_mismatch(spark, sf_dir):
    """O-56: customers whose last order month is not the last month."""
    books, units = grid(spark, sf_dir)
    return QA.chapter_mismatch(books, units)


@register("chapter_gaps", oracle=GRID_SQL + """
SELECT g.key, CAST(g.chapter AS INTEGER) AS chapter FROM (
  SELECT key, unnest(range(1, expected + 1)) AS chapter FROM bk
  WHERE key IN (SELECT key FROM u)) g
WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.key = g.key AND u.chapter = g.chapter)
""")
def q_chapter_gaps(spark, sf_dir):
    """O-58: (customer, month) pairs of the expected grid with no order."""
    books, units = grid(spark, sf_dir)
    return QA.chapter_gaps(books, units)


@register("audit_status", oracle=GRID_SQL + """,
st AS (SELECT key, max(chapter) AS mx FROM u GROUP BY key)
SELECT bk.key, CASE WHEN st.mx IS NULL THEN 'missing'
                    WHEN st.mx = bk.expected THEN 'ok'
                    ELSE CAST(st.mx AS VARCHAR) || ' of ' || CAST(bk.expected AS VARCHAR) END
       AS status
FROM bk LEFT JOIN st ON st.key = bk.key
""")
def q_audit_status(spark, sf_dir):
    """O-59: per-customer status."""
    books, units = grid(spark, sf_dir)
    return QA.audit(books, units)[0]


@register("audit_verdict", oracle=GRID_SQL + """,
st AS (SELECT key, max(chapter) AS mx FROM u GROUP BY key),
s AS (SELECT bk.key, st.mx, bk.expected FROM bk LEFT JOIN st ON st.key = bk.key)
SELECT count(*) FILTER (WHERE mx IS NULL) AS n_missing,
       count(*) FILTER (WHERE mx IS NOT NULL AND mx <> expected) AS n_mismatch,
       coalesce(bool_and(mx IS NOT NULL AND mx = expected), true) AS complete
FROM s
""")
def q_audit_verdict(spark, sf_dir):
    """O-59: the one-row verdict."""
    books, units = grid(spark, sf_dir)
    return QA.audit(books, units)[1]


@register("verse_gaps", oracle=with_(UNITS) + """,
nb AS (SELECT book_name, chapter, CAST(verse + verse // 5 AS INTEGER) AS verse FROM units),
mx AS (SELECT book_name, chapter, max(verse) AS m FROM nb GROUP BY book_name, chapter),
g AS (SELECT book_name, chapter, CAST(unnest(range(1, m + 1)) AS INTEGER) AS verse FROM mx)
SELECT g.book_name, g.chapter, g.verse FROM g
WHERE NOT EXISTS (SELECT 1 FROM nb x WHERE x.book_name = g.book_name
                  AND x.chapter = g.chapter AND x.verse = g.verse)
""")
def q_verse_gaps(spark, sf_dir):
    """O-58: holes in the numbering of every document's lines (empty lines; every fifth
    line is numbered one further, so that all longer documents have some)."""
    u = S.doc_units(spark, sf_dir).select("book_name", "chapter", (
        F.col("verse") + F.floor(F.col("verse") / 5).cast("int")).alias("verse"))
    return QA.verse_gaps(u, ["book_name", "chapter"])
