"""Unit queries over document lines (O-35, O-37..O-49, O-54, O-86)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.operators import query as Q
from corpuslink.operators import text_index as X
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import EDGES, UNITS, with_
from corpuslink.session import scratch_path

UNIT_COLS = ("verse_id", "book_name", "testament", "book_number", "chapter", "verse", "text",
             "reference")

# Query parameters of the demo queries (the reference's demo asks for one verse,
# one chapter head and one phrase; these name existing keys of the test tables).
LOOKUP_KEY = ("src3", 3, 1)
HEAD_KEY = ("src5", 5)
HEAD_N = 3
NEEDLE = "und die"
SEARCH_N = 20
HAVING_MIN = 20


@register("unit_view", oracle=with_(UNITS) + f"SELECT {', '.join(UNIT_COLS)} FROM units")
def q_unit_view(spark, sf_dir):
    """O-35 + O-86: the denormalised unit view with its reference string."""
    return S.doc_units(spark, sf_dir).select(*UNIT_COLS)


@register("unit_lookup", oracle=with_(UNITS) + f"""
SELECT reference, text FROM units
WHERE book_name = '{LOOKUP_KEY[0]}' AND chapter = {LOOKUP_KEY[1]} AND verse = {LOOKUP_KEY[2]}
""")
def q_unit_lookup(spark, sf_dir):
    """O-37: point lookup by (book, chapter, verse)."""
    return Q.lookup(S.doc_units(spark, sf_dir), *LOOKUP_KEY).select("reference", "text")


@register("chapter_head", oracle=with_(UNITS) + f"""
SELECT verse, text FROM units
WHERE book_name = '{HEAD_KEY[0]}' AND chapter = {HEAD_KEY[1]}
ORDER BY verse LIMIT {HEAD_N}
""")
def q_chapter_head(spark, sf_dir):
    """O-38: the first verses of one chapter in verse order."""
    return Q.chapter(S.doc_units(spark, sf_dir), *HEAD_KEY, n=HEAD_N).select("verse", "text")


@register("chapters_of", oracle=with_(UNITS) + """
SELECT DISTINCT book_number, book_name, chapter FROM units
""")
def q_chapters_of(spark, sf_dir):
    """O-41: chapters present per book, all books in one pass."""
    return Q.chapters_of(S.doc_units(spark, sf_dir))


@register("text_search", oracle=with_(UNITS) + f"""
SELECT reference, text FROM units WHERE text ILIKE '%{NEEDLE}%'
ORDER BY book_number, chapter, verse LIMIT {SEARCH_N}
""")
def q_text_search(spark, sf_dir):
    """O-39: case-insensitive substring search, first n in canonical order."""
    return Q.search_text(S.doc_units(spark, sf_dir), NEEDLE, SEARCH_N).select("reference", "text")


@register("text_search_all", oracle=with_(UNITS) + f"""
SELECT reference, text FROM units WHERE text ILIKE '%{NEEDLE}%'
""")
def q_text_search_all(spark, sf_dir):
    """O-39 without a limit: every matching unit."""
    return Q.search_text(S.doc_units(spark, sf_dir), NEEDLE).select("reference", "text")


NEEDLES = (NEEDLE, NEEDLE[:2], NEEDLE.upper() + " ", "no such words in here", "100%")


@register("text_search_indexed", oracle=with_(UNITS) + f"""
SELECT n.needle, reference, text FROM units,
       (SELECT unnest([{', '.join(repr(n) for n in NEEDLES)}]) AS needle) n
WHERE contains(lower(text), lower(n.needle))
""")
def q_text_search_indexed(spark, sf_dir):
    """O-39 through a trigram index over all units: needles of many hits, of none, of two
    characters (a scan), with wildcards of LIKE."""
    path = scratch_path(spark, f"text-index-{uuid.uuid4().hex}")
    X.build_text_index(S.doc_units(spark, sf_dir), path, parts=16)
    found = [X.search_index(spark, path, needle).select(
        F.lit(needle).alias("needle"), "reference", "text") for needle in NEEDLES]
    return reduce(DataFrame.union, found)


@register("group_counts", oracle=with_(UNITS, EDGES) + """
SELECT (SELECT count(DISTINCT source) FROM documents) AS n_books,
       (SELECT count(*) FROM units) AS n_units,
       (SELECT count(*) FROM edges) AS n_links
""")
def q_group_counts(spark, sf_dir):
    """O-44: global counts of books, units and links in one row."""
    return Q.counts(books=S.doc_books(spark, sf_dir), units=S.doc_verses(spark, sf_dir),
                    links=S.link_edges(spark, sf_dir))


@register("distinct_counts", oracle=with_(UNITS) + """
SELECT book_number, book_name, count(DISTINCT chapter) AS n_chapters
FROM units GROUP BY book_number, book_name
""")
def q_distinct_counts(spark, sf_dir):
    """O-45: distinct chapters per book."""
    return Q.distinct_counts(S.doc_units(spark, sf_dir))


@register("books_with_units", oracle=with_(UNITS) + """
SELECT count(DISTINCT book_name) AS n_books FROM units
""")
def q_books_with_units(spark, sf_dir):
    """O-45: books that have at least one unit."""
    return Q.books_with_units(S.doc_units(spark, sf_dir))


@register("by_group", oracle=with_(UNITS) + """
SELECT testament, count(*) AS n_units FROM units GROUP BY testament
""")
def q_by_group(spark, sf_dir):
    """O-46: units per testament."""
    return Q.by_group(S.doc_units(spark, sf_dir))


@register("largest_group", oracle=with_(UNITS) + """
SELECT book_name, count(*) AS n_units FROM units GROUP BY book_name
ORDER BY n_units DESC, book_name LIMIT 1
""")
def q_largest_group(spark, sf_dir):
    """O-47: the book with the most units."""
    return Q.largest(S.doc_units(spark, sf_dir))


@register("max_member", oracle=with_(UNITS) + """
SELECT book_number, book_name, max(chapter) AS max_chapter FROM units
GROUP BY book_number, book_name
""")
def q_max_member(spark, sf_dir):
    """O-48: highest chapter per book."""
    return Q.max_chapter(S.doc_units(spark, sf_dir))


@register("having_count", oracle=with_(UNITS) + f"""
SELECT book_number, book_name, chapter, count(*) AS n_units FROM units
GROUP BY book_number, book_name, chapter HAVING count(*) >= {HAVING_MIN}
""")
def q_having_count(spark, sf_dir):
    """O-49: chapters with at least HAVING_MIN units."""
    return Q.verses_per_chapter(S.doc_units(spark, sf_dir), min_count=HAVING_MIN)


@register("filter_units", oracle=with_(UNITS) + """
SELECT verse_id, reference FROM units
WHERE testament = 'Old' AND book_name IN ('src1', 'src4', 'src12')
""")
def q_filter_units(spark, sf_dir):
    """O-42: testament equality and book membership (src12 is New, so it drops out)."""
    return Q.filter_units(S.doc_units(spark, sf_dir), testament="Old",
                          books=["src1", "src4", "src12"]).select("verse_id", "reference")


@register("canonical_order", oracle=with_(UNITS) + """
SELECT verse_id, CAST(row_number() OVER (ORDER BY book_number, chapter, verse) AS BIGINT) AS pos
FROM units
""")
def q_canonical_order(spark, sf_dir):
    """O-54 + O-13: canonical position of every unit as a dense id (scale-safe)."""
    from corpuslink.operators.upsert import assign_ids
    u = S.doc_units(spark, sf_dir).select("verse_id", *Q.UNIT_ORDER)
    return assign_ids(u, list(Q.UNIT_ORDER), "pos").select("verse_id", "pos")
