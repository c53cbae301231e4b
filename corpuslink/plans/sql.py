"""DuckDB fragments that restate the stand-ins for the oracle queries.

They mirror ``standins.py`` table for table; each oracle is written from the
operator's definition, not from our Spark plan.
"""

UNITS = """
doc_lines AS (
  SELECT doc_id, source, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
units AS (
  SELECT CAST(doc_id * 4294967296 + pos AS BIGINT) AS verse_id,
         source AS book_name,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'Old' ELSE 'New' END AS testament,
         CAST(substr(source, 4) AS INTEGER) + 1 AS book_number,
         doc_id AS chapter,
         CAST(pos AS INTEGER) AS verse,
         line AS text,
         source || ' ' || CAST(doc_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) AS reference
  FROM doc_lines WHERE line <> '')
"""

EDGES = """
edges AS (
  SELECT from_id, to_id, votes FROM (
    SELECT l_orderkey AS from_id, l_partkey AS to_id,
           CAST(floor(l_quantity) AS INTEGER) AS votes,
           row_number() OVER (PARTITION BY l_orderkey, l_partkey
                              ORDER BY l_linenumber, l_suppkey, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1)
"""

ENDS = """
from_units AS (
  SELECT o_orderkey AS from_id, o_orderpriority AS from_book, o_custkey AS from_chapter,
         o_orderkey AS from_verse FROM orders),
to_units AS (
  SELECT p_partkey AS to_id, p_brand AS to_book, p_size AS to_chapter,
         p_partkey AS to_verse FROM part)
"""

VECTORS = """
vecs AS (
  SELECT *, list_transform(vec, lambda x: x / sqrt(list_sum(list_transform(vec,
            lambda y: y * y)))) AS unit FROM (
  SELECT e.vec_id AS verse_id, 'book' || CAST(e.label AS VARCHAR) AS book_name,
         CASE WHEN e.label < 5 THEN 'Old' ELSE 'New' END AS testament,
         e.label + 1 AS book_number, e.label AS chapter, e.vec_id AS verse,
         'book' || CAST(e.label AS VARCHAR) || ' ' || CAST(e.label AS VARCHAR) || ':'
           || CAST(e.vec_id AS VARCHAR) AS reference,
         coalesce(d.text, '') AS text,
         list_transform(CAST(e.embedding AS DOUBLE[]), lambda x: x * (1 + e.vec_id % 7)) AS vec
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)),
cent AS (
  SELECT chapter AS qid, list(m ORDER BY i) AS c FROM (
    SELECT chapter, i, avg(x) AS m FROM (
      SELECT chapter, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS i FROM vecs)
    GROUP BY chapter, i)
  GROUP BY chapter),
centn AS (
  SELECT qid, list_transform(c, lambda x: x / n) AS qv FROM (
    SELECT qid, c, sqrt(list_sum(list_transform(c, lambda y: y * y))) AS n FROM cent))
"""

def ref(book: str, chapter: str, verse: str) -> str:
    return (f"{book} || ' ' || CAST({chapter} AS VARCHAR) || ':' || "
            f"CAST({verse} AS VARCHAR)")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
