"""Parsing, link import and rendering queries (O-03, O-20..O-34, O-82..O-95).

Stand-ins:
* parse input: all conversation turns, written as ``{turn+1}{text}`` lines; ten
  conversations per book ``'Book {conv_id div 10}'`` with the book name as a title line.
  Parsing must give back the turns with an opening capital; the others follow the
  policies (see ``CONV_SQL``).
* link dumps: one statement per line item, formatted from lineitem, orders and
  part: from (priority, customer + line number div 6, order) to (brand, size,
  part .. part + q%4 - 1) with votes ``q - 10`` (negative votes fail to parse, D7;
  every fiftieth supplier's are no 64-bit number). They are landed as files and read
  back. Sources resolve against orders (line numbers from 6 on find none), targets
  against part.
* chapters to render: conversations (no links) and customers' orders with
  their top-10 part links.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslink.functions.text import fmt_decimal, fmt_int, preview, safe_name, squash_ws, wiki_link
from corpuslink.operators import links as L
from corpuslink.operators import parse as P
from corpuslink.operators import render as R
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import EDGES, UNITS, with_
from corpuslink.session import scratch_path
from corpuslink.sources.linkdump import read_link_dump, reject_sample, write_link_dump

BOOK_SIZE = 10

# ---------------------------------------------------------------- parsing ---

# A turn without an opening capital has no pattern of its own: under the loose policy its
# line joins the text before it (or nothing, at a book's start); under the line policy it is
# lost, since a unit's text ends with its line.
CONV_SQL = f"""
WITH conv AS (
  SELECT 'Book ' || CAST(conv_id // {BOOK_SIZE} AS VARCHAR) AS book, conv_id, turn,
         CAST(turn + 1 AS INTEGER) AS num, text
  FROM conversations),
grouped AS (
  SELECT *, sum(CASE WHEN regexp_matches(text, '^[A-Z]') THEN 1 ELSE 0 END)
              OVER (PARTITION BY book ORDER BY conv_id, turn) AS g FROM conv),
loose AS (
  SELECT book, g, min(conv_id) AS conv_id, first(num ORDER BY conv_id, turn) AS num,
         string_agg(CASE WHEN regexp_matches(text, '^[A-Z]') THEN text
                         ELSE CAST(num AS VARCHAR) || text END, chr(10) ORDER BY conv_id, turn)
           AS text
  FROM grouped WHERE g > 0 GROUP BY book, g),
firsts AS (
  SELECT book, conv_id, turn, num,
         trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g')) AS text
  FROM conv WHERE regexp_matches(text, '^[A-Z"'']'))
"""


def conv_books(spark, sf_dir, sep=10, title="Book "):
    c = S.table(spark, sf_dir, "conversations")
    c = c.withColumn("book", F.concat(F.lit(title),
                                      F.floor(F.col("conv_id") / BOOK_SIZE).cast("string")))
    body = F.expr(f"listagg(concat(cast(turn + 1 as string), text), char({sep})) "
                  "WITHIN GROUP (ORDER BY conv_id, turn)")
    return c.groupBy("book").agg(body.alias("_body"),
                                 F.countDistinct("conv_id").cast("int").alias("expected")) \
        .select("book", F.concat("book", F.lit("\n"), "_body").alias("text"), "expected")


@register("parse_loose", oracle=CONV_SQL + f"""
, seq AS (
  SELECT book, num, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text,
         CASE WHEN num <= 2 AND lag(num, 1, 0) OVER (PARTITION BY book ORDER BY g) > 10
              THEN 1 ELSE 0 END AS f, g
  FROM loose)
SELECT book, CAST(1 + sum(f) OVER (PARTITION BY book ORDER BY g
                                   ROWS UNBOUNDED PRECEDING) AS INTEGER) AS chapter,
       num AS verse, text
FROM seq WHERE text <> ''
""")
def q_parse_loose(spark, sf_dir):
    """O-20, O-22, O-25, O-26, O-27: title strip, loose split, reset-after-10 chapters."""
    return P.parse_book_text(conv_books(spark, sf_dir), "v1") \
        .select("book", "chapter", "verse", "text")


@register("parse_line", oracle=CONV_SQL + f"""
, kept AS (SELECT * FROM firsts WHERE length(text) >= 3),
exp AS (SELECT book, CAST(count(DISTINCT conv_id) AS INTEGER) AS expected FROM conv GROUP BY book),
seq AS (
  SELECT k.*, e.expected,
         CASE WHEN num = 1 AND lag(num, 1, 0) OVER (PARTITION BY k.book ORDER BY conv_id, turn) > 3
              THEN 1 ELSE 0 END AS f
  FROM kept k JOIN exp e USING (book))
SELECT book, CAST(least(1 + sum(f) OVER (PARTITION BY book ORDER BY conv_id, turn
                                         ROWS UNBOUNDED PRECEDING), expected) AS INTEGER) AS chapter,
       num AS verse, text
FROM seq WHERE num > 0
""")
def q_parse_line(spark, sf_dir):
    """O-21, O-23, O-24, O-26, O-28: line split (first line only, D8), reset-to-1
    chapters capped at the expected count."""
    return P.parse_book_text(conv_books(spark, sf_dir), "v2", expected="expected") \
        .select("book", "chapter", "verse", "text")


@register("parse_fallback", oracle=f"""
WITH conv AS (
  SELECT 'Flat ' || CAST(conv_id // {BOOK_SIZE} AS VARCHAR) AS book, conv_id, turn,
         CAST(turn + 1 AS INTEGER) AS num, text FROM conversations),
grouped AS (
  SELECT *, sum(CASE WHEN regexp_matches(text, '^[A-Z]') THEN 1 ELSE 0 END)
              OVER (PARTITION BY book ORDER BY conv_id, turn) AS g FROM conv),
loose AS (
  SELECT book, g, first(num ORDER BY conv_id, turn) AS num, trim(regexp_replace(
           string_agg(CASE WHEN regexp_matches(text, '^[A-Z]') THEN text
                           ELSE CAST(num AS VARCHAR) || text END, ' ' ORDER BY conv_id, turn),
           '\\s+', ' ', 'g')) AS text
  FROM grouped WHERE g > 0 GROUP BY book, g),
exp AS (SELECT book, CAST(count(DISTINCT conv_id) AS INTEGER) AS expected FROM conv GROUP BY book),
seq AS (
  SELECT k.*, e.expected, CASE WHEN num = 1 AND lag(num, 1, 0) OVER (PARTITION BY k.book
                                 ORDER BY g) > 3 THEN 1 ELSE 0 END AS f
  FROM loose k JOIN exp e USING (book) WHERE length(text) >= 3)
SELECT book, CAST(least(1 + sum(f) OVER (PARTITION BY book ORDER BY g
                                         ROWS UNBOUNDED PRECEDING), expected) AS INTEGER) AS chapter,
       num AS verse, text
FROM seq WHERE num > 0
""")
def q_parse_fallback(spark, sf_dir):
    """O-24: books whose units all stand in one line, where the line pattern finds nothing
    and the loose one takes over."""
    books = conv_books(spark, sf_dir, sep=32, title="Flat ")
    # a word before the first number, so that not even the first unit starts a line
    books = books.withColumn("text", F.concat(
        "book", F.lit("\nso "), F.expr("substring(text, length(book) + 2)")))
    return P.parse_book_text(books, "v2", expected="expected") \
        .select("book", "chapter", "verse", "text")


def one_book(spark, sf_dir):
    """All conversations as one book, far larger than a chunk."""
    body = F.expr("listagg(concat(cast(turn + 1 as string), text), char(10)) "
                  "WITHIN GROUP (ORDER BY conv_id, turn)")
    return S.table(spark, sf_dir, "conversations").agg(
        body.alias("_body"), F.countDistinct("conv_id").cast("int").alias("expected")).select(
        F.lit("All").alias("book"), F.concat(F.lit("All\n"), "_body").alias("text"), "expected")


ONE_BOOK_SQL = CONV_SQL.replace(f"'Book ' || CAST(conv_id // {BOOK_SIZE} AS VARCHAR)", "'All'")
CHUNK = 4_000


@register("parse_chunked", oracle=ONE_BOOK_SQL + """
, seq AS (
  SELECT 'v1' AS policy, book, g AS k, num, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text,
         CASE WHEN num <= 2 AND lag(num, 1, 0) OVER (PARTITION BY book ORDER BY g) > 10
              THEN 1 ELSE 0 END AS f FROM loose),
seq2 AS (
  SELECT 'v2' AS policy, book, conv_id, turn, num, text,
         CASE WHEN num = 1 AND lag(num, 1, 0) OVER (PARTITION BY book ORDER BY conv_id, turn) > 3
              THEN 1 ELSE 0 END AS f FROM firsts WHERE length(text) >= 3),
n AS (SELECT count(DISTINCT conv_id) AS expected FROM conv)
SELECT policy, book, k - 1 AS pos, CAST(1 + sum(f) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING)
         AS INTEGER) AS chapter, num AS verse, text
FROM seq WHERE text <> ''
UNION ALL
SELECT policy, book, NULL, CAST(least(1 + sum(f) OVER (ORDER BY conv_id, turn ROWS UNBOUNDED
         PRECEDING), expected) AS INTEGER), num, text
FROM seq2, n WHERE num > 0
""")
def q_parse_chunked(spark, sf_dir):
    """O-20..O-28 on one huge book, parsed in chunks by many tasks under both policies."""
    book = one_book(spark, sf_dir)
    cols = ["book", "pos", "chapter", "verse", "text"]
    v1 = P.parse_book_text(book, "v1", chunk_chars=CHUNK).select(F.lit("v1").alias("policy"), *cols)
    v2 = P.parse_book_text(book, "v2", expected="expected", chunk_chars=CHUNK).withColumn(
        "pos", F.lit(None).cast("long")).select(F.lit("v2").alias("policy"), *cols)
    return v1.union(v2)


@register("title_strip", oracle=CONV_SQL + """
, books AS (
  SELECT book, book || chr(10) || string_agg(CAST(num AS VARCHAR) || text, chr(10)
                                            ORDER BY conv_id, turn) AS text
  FROM conv GROUP BY book)
SELECT book,
       regexp_replace(text, '^' || book || '\\s*', '', 'i') AS start_policy,
       trim(regexp_replace(text, '(?m)^' || book || '\\s*\\n*', '', 'gi')) AS lines_policy
FROM books
""")
def q_title_strip(spark, sf_dir):
    """O-20 / O-21: the book name removed once at the start, or from every line."""
    books = conv_books(spark, sf_dir).select("book", "text")
    a = P.strip_title(books, "text", "book", "start").withColumnRenamed("text", "start_policy")
    b = P.strip_title(books, "text", "book", "lines").withColumnRenamed("text", "lines_policy")
    return a.join(b, "book")


@register("verse_gaps_parsed", oracle=CONV_SQL + f"""
, kept AS (SELECT * FROM firsts WHERE length(text) >= 3),
exp AS (SELECT book, CAST(count(DISTINCT conv_id) AS INTEGER) AS expected FROM conv GROUP BY book),
seq AS (
  SELECT k.*, e.expected,
         CASE WHEN num = 1 AND lag(num, 1, 0) OVER (PARTITION BY k.book ORDER BY conv_id, turn) > 3
              THEN 1 ELSE 0 END AS f
  FROM kept k JOIN exp e USING (book)),
u AS (
  SELECT book, CAST(least(1 + sum(f) OVER (PARTITION BY book ORDER BY conv_id, turn
                                           ROWS UNBOUNDED PRECEDING), expected) AS INTEGER)
           AS chapter, num AS verse
  FROM seq WHERE num > 0),
mx AS (SELECT book, chapter, max(verse) AS m FROM u GROUP BY book, chapter),
g AS (SELECT book, chapter, CAST(unnest(range(1, m + 1)) AS INTEGER) AS verse FROM mx)
SELECT g.book, g.chapter, g.verse FROM g
WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.book = g.book AND u.chapter = g.chapter
                  AND u.verse = g.verse)
""")
def q_verse_gaps_parsed(spark, sf_dir):
    """O-58 on parsed units: verse numbers missing inside a chapter (turns that
    were not in the source text)."""
    from corpuslink.operators.quality import verse_gaps
    u = P.parse_book_text(conv_books(spark, sf_dir), "v2", expected="expected")
    return verse_gaps(u.select("book", "chapter", "verse"), ["book", "chapter"])


@register("load_report", oracle=CONV_SQL + f"""
, kept AS (SELECT * FROM firsts WHERE length(text) >= 3),
exp AS (SELECT book, CAST(count(DISTINCT conv_id) AS INTEGER) AS expected FROM conv GROUP BY book),
seq AS (
  SELECT k.*, e.expected,
         CASE WHEN num = 1 AND lag(num, 1, 0) OVER (PARTITION BY k.book ORDER BY conv_id, turn) > 3
              THEN 1 ELSE 0 END AS f
  FROM kept k JOIN exp e USING (book)),
ch AS (
  SELECT book, least(1 + sum(f) OVER (PARTITION BY book ORDER BY conv_id, turn
                                      ROWS UNBOUNDED PRECEDING), expected) AS chapter
  FROM seq WHERE num > 0)
SELECT e.book, e.expected, coalesce(count(ch.book), 0) AS n_units,
       coalesce(count(DISTINCT ch.chapter), 0) AS n_chapters
FROM exp e LEFT JOIN ch USING (book) GROUP BY e.book, e.expected
""")
def q_load_report(spark, sf_dir):
    """O-29: per book units, distinct chapters and the expected count."""
    books = conv_books(spark, sf_dir)
    units = P.parse_book_text(books, "v2", expected="expected")
    return P.load_report(units, books).select("book", "expected", "n_units", "n_chapters")


@register("assemble_pages", oracle="""
SELECT conv_id AS book, string_agg(text || chr(10), '' ORDER BY turn) AS text,
       CASE WHEN length(CAST(conv_id + 1 AS VARCHAR)) >= 2 THEN CAST(conv_id + 1 AS VARCHAR)
            ELSE lpad(CAST(conv_id + 1 AS VARCHAR), 2, '0') END AS file_no
FROM conversations GROUP BY conv_id
""")
def q_assemble_pages(spark, sf_dir):
    """O-93: a conversation's turns as pages of one book text."""
    c = S.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("book"), F.col("turn").alias("page"), "text",
        (F.col("conv_id") + 1).alias("book_number"))
    return P.assemble_pages(c, book_number="book_number").select("book", "text", "file_no")


@register("squash_ws", oracle="""
SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents
""")
def q_squash_ws(spark, sf_dir):
    """O-25: whitespace normalisation of whole documents."""
    d = S.table(spark, sf_dir, "documents")
    return d.select("doc_id", squash_ws("text").alias("text"))


# ------------------------------------------------------------ link import ---

STMT_SQL = """
WITH stmts AS (
  SELECT 'cross_references_' || l.l_returnflag || '.sql' AS file,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
         o.o_orderpriority AS from_book,
         o.o_custkey + CAST(l.l_linenumber // 6 AS BIGINT) AS from_chapter,
         o.o_orderkey AS from_verse,
         p.p_brand AS to_book, CAST(p.p_size AS BIGINT) AS to_chapter,
         p.p_partkey AS to_verse_start,
         p.p_partkey + CAST(floor(l.l_quantity) AS BIGINT) % 4 - 1 AS to_verse_end,
         CASE WHEN l.l_suppkey % 50 = 0 THEN 0 ELSE CAST(floor(l.l_quantity) AS BIGINT) - 10 END
           AS votes,
         CASE WHEN l.l_suppkey % 50 = 0 THEN '99999999999999999999'
              ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) - 10 AS VARCHAR) END AS votes_text
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                  JOIN part p ON p.p_partkey = l.l_partkey),
parsed AS (SELECT *, votes >= 0 AND to_verse_end >= 0 AS matched FROM stmts),
ok AS (SELECT * FROM parsed WHERE matched),
expd AS (SELECT ok.*, unnest(range(to_verse_start, to_verse_end + 1)) AS to_verse FROM ok),
fu AS (SELECT o_orderkey AS from_id, o_orderpriority AS b, o_custkey AS c, o_orderkey AS v
       FROM orders),
tu AS (SELECT p_partkey AS to_id, p_brand AS b, CAST(p_size AS BIGINT) AS c, p_partkey AS v
       FROM part),
res AS (
  SELECT e.*, fu.from_id, tu.to_id FROM expd e
  LEFT JOIN fu ON fu.b = e.from_book AND fu.c = e.from_chapter AND fu.v = e.from_verse
  LEFT JOIN tu ON tu.b = e.to_book AND tu.c = e.to_chapter AND tu.v = e.to_verse),
winners AS (
  SELECT * FROM res WHERE from_id IS NOT NULL AND to_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY from_id, to_id
    ORDER BY file, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, to_verse) = 1)
"""

LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


STATEMENT_FIELDS = ("o_orderpriority", "o_custkey", "p_brand", "p_size")


def statement():
    """A statement line of a row's fields. The row's keys follow as an SQL comment."""
    q = F.floor("l_quantity").cast("long")
    votes = F.when(F.col("l_suppkey") % 50 == 0, F.lit("99999999999999999999")).otherwise(
        (q - 10).cast("string"))
    return F.format_string(
        "INSERT INTO cross_references VALUES ('%s', %d, %d, '%s', %d, %d, %d, %s);"
        " -- %d %d %d %d",
        "o_orderpriority", F.col("o_custkey") + F.floor(F.col("l_linenumber") / 6).cast("long"),
        F.col("l_orderkey").cast("long"), "p_brand", F.col("p_size").cast("long"),
        F.col("l_partkey").cast("long"), F.col("l_partkey") + q % 4 - 1, votes,
        F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long"),
        F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long"))


def link_lines(spark, sf_dir):
    """The fields of the statement lines (file, line order columns, what ``statement`` takes)."""
    li = S.table(spark, sf_dir, "lineitem")
    o = S.table(spark, sf_dir, "orders")
    p = S.table(spark, sf_dir, "part")
    # the orders last: rows sorted by order key make smaller shuffle files for the dump's order
    return (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
            .select(F.concat(F.lit("cross_references_"), "l_returnflag", F.lit(".sql"))
                    .alias("file"), *LINE_ORDER, *STATEMENT_FIELDS))


def link_dump(spark, sf_dir):
    """The statements landed as dump files and read back: (file, line_no, value, …)."""
    path = scratch_path(spark, f"dump-{uuid.uuid4().hex}")
    write_link_dump(link_lines(spark, sf_dir), path, LINE_ORDER, statement())
    return read_link_dump(spark, path)


def _keyed(df):
    """The row's keys, from the comment behind its statement."""
    keys = F.split(F.substring_index("value", " -- ", -1), " ")
    types = ("long", "int", "long", "long")
    return df.withColumns({c: keys[i].cast(t) for i, (c, t) in enumerate(zip(KEYS, types))})


KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _ends(spark, sf_dir):
    fu = S.order_units(spark, sf_dir)
    tu = S.part_units(spark, sf_dir).withColumn("chapter", F.col("chapter").cast("long"))
    return fu, tu


def _import(spark, sf_dir, extra=(), **how):
    parsed = link_dump(spark, sf_dir)
    fu, tu = _ends(spark, sf_dir)
    return L.import_links(_keyed(parsed) if extra else parsed, fu, tu,
                          order=("file", "line_no", "to_verse", *extra), **how)


@register("dump_parse", oracle=STMT_SQL + """
SELECT file, l_orderkey, l_linenumber, l_partkey, l_suppkey, matched,
       CASE WHEN matched THEN from_book END AS from_book,
       CASE WHEN matched THEN from_chapter END AS from_chapter,
       CASE WHEN matched THEN from_verse END AS from_verse,
       CASE WHEN matched THEN to_book END AS to_book,
       CASE WHEN matched THEN to_chapter END AS to_chapter,
       CASE WHEN matched THEN to_verse_start END AS to_verse_start,
       CASE WHEN matched THEN to_verse_end END AS to_verse_end,
       CASE WHEN matched THEN try_cast(votes_text AS BIGINT) END AS votes
FROM parsed
""")
def q_dump_parse(spark, sf_dir):
    """O-03: statements parsed back into their eight fields."""
    return _keyed(link_dump(spark, sf_dir)).drop("value", "line_no")


@register("range_expand", oracle=STMT_SQL + """
SELECT file, l_orderkey, l_linenumber, l_partkey, l_suppkey, to_verse FROM expd
""")
def q_range_expand(spark, sf_dir):
    """O-30: one row per target verse of each range (empty when end < start)."""
    parsed = _keyed(link_dump(spark, sf_dir)).filter("matched")
    return L.expand_ranges(parsed, "to_verse_start", "to_verse_end").select(
        "file", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "to_verse")


@register("resolve_refs", oracle=STMT_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, to_verse, from_id, to_id FROM res
""")
def q_resolve_refs(spark, sf_dir):
    """O-31: both ends resolved by joins (NULL when unknown)."""
    return _import(spark, sf_dir, KEYS, only_resolved=True)["resolved"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "to_verse", "from_id", "to_id")


@register("edge_import", oracle=STMT_SQL + """
SELECT from_id, to_id, votes FROM winners
""")
def q_edge_import(spark, sf_dir):
    """O-32 (+O-17): first-wins edges in (file, line, target) order."""
    return _import(spark, sf_dir)["edges"]


@register("import_report", oracle=STMT_SQL + """
, lines AS (SELECT file, count(*) AS lines_processed,
                   count(*) FILTER (WHERE NOT matched) AS unparsed FROM parsed GROUP BY file),
fm AS (SELECT file, count(*) AS n FROM ok WHERE NOT EXISTS (
         SELECT 1 FROM fu WHERE fu.b = ok.from_book AND fu.c = ok.from_chapter
                            AND fu.v = ok.from_verse) GROUP BY file),
tm AS (SELECT file, count(*) AS n FROM res WHERE from_id IS NOT NULL AND to_id IS NULL
       GROUP BY file),
imp AS (SELECT file, count(*) AS n FROM winners GROUP BY file)
SELECT l.file, l.lines_processed, coalesce(imp.n, 0) AS imported,
       coalesce(fm.n, 0) + coalesce(tm.n, 0) AS skipped, l.unparsed
FROM lines l LEFT JOIN fm USING (file) LEFT JOIN tm USING (file) LEFT JOIN imp USING (file)
""")
def q_import_report(spark, sf_dir):
    """O-33: per-file accounting."""
    return _import(spark, sf_dir)["report"]


BY_BATCH = STMT_SQL + """
, lines AS (SELECT file, count(*) AS lines_processed,
                   count(*) FILTER (WHERE NOT matched) AS unparsed FROM parsed GROUP BY file),
fm AS (SELECT file, count(*) AS n FROM ok WHERE NOT EXISTS (
         SELECT 1 FROM fu WHERE fu.b = ok.from_book AND fu.c = ok.from_chapter
                            AND fu.v = ok.from_verse) GROUP BY file),
tm AS (SELECT file, count(*) AS n FROM res WHERE from_id IS NOT NULL AND to_id IS NULL
       GROUP BY file),
imp AS (SELECT file, count(*) AS n, sum(votes) AS v FROM winners GROUP BY file)
SELECT l.file, l.lines_processed, coalesce(imp.n, 0) AS imported,
       coalesce(fm.n, 0) + coalesce(tm.n, 0) AS skipped, l.unparsed,
       coalesce(imp.n, 0) AS n_edges, CAST(coalesce(imp.v, 0) AS BIGINT) AS votes
FROM lines l LEFT JOIN fm USING (file) LEFT JOIN tm USING (file) LEFT JOIN imp USING (file)
"""


@register("import_batches", oracle=BY_BATCH)
def q_import_batches(spark, sf_dir):
    """O-32, O-33 into a filled table: the dump files imported one after another, the second one
    twice; the accounting and the edges each file added are those of one import."""
    from corpuslink.streaming.links import import_batch, read_edges, read_report
    target = scratch_path(spark, f"edges-{uuid.uuid4().hex}")
    parsed = link_dump(spark, sf_dir)
    fu, tu = _ends(spark, sf_dir)
    names = [r.file for r in parsed.select("file").distinct().orderBy("file").collect()]  # 3 files
    for i in (0, 1, 1, 2):
        import_batch(parsed.where(F.col("file") == names[i]), i, target, fu, tu)
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
    added = read_edges(spark, target).groupBy(number[F.col("batch").cast("int")].alias("file")).agg(
        F.count(F.lit(1)).alias("n_edges"), F.sum("votes").alias("votes"))
    return read_report(spark, target).join(added, "file", "left").na.fill(0, ["n_edges", "votes"])


@register("reject_sample", oracle=STMT_SQL + """
SELECT file, printf('INSERT INTO cross_references VALUES (''%s'', %d, %d, ''%s'', %d, %d, %d, %s);'
                    || ' -- %d %d %d %d',
                    from_book, from_chapter, from_verse, to_book, to_chapter, to_verse_start,
                    to_verse_end, votes_text, l_orderkey, l_linenumber, l_partkey, l_suppkey)
         AS value
FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY l_orderkey, l_linenumber,
                                   l_partkey, l_suppkey, l_quantity) AS r FROM parsed)
WHERE r <= 3 AND NOT matched
""")
def q_reject_sample(spark, sf_dir):
    """O-34: failed statements among the first three of each file."""
    return reject_sample(link_dump(spark, sf_dir), [F.col("line_no")], 3)


# -------------------------------------------------------------- rendering ---

def conv_units(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    g = F.floor(F.col("conv_id") / BOOK_SIZE)
    return c.select(F.concat(F.lit("Book "), g.cast("string")).alias("book_name"),
                    F.when(g < 5, "Old").otherwise("New").alias("testament"),
                    (g + 1).cast("int").alias("book_number"),
                    F.col("conv_id").alias("chapter"), (F.col("turn") + 1).alias("verse"),
                    "text")


CONV_UNITS_SQL = f"""
WITH cu AS (
  SELECT 'Book ' || CAST(conv_id // {BOOK_SIZE} AS VARCHAR) AS book_name,
         CASE WHEN conv_id // {BOOK_SIZE} < 5 THEN 'Old' ELSE 'New' END AS testament,
         CAST(conv_id // {BOOK_SIZE} + 1 AS INTEGER) AS book_number,
         conv_id AS chapter, turn + 1 AS verse, text FROM conversations)
"""


@register("render_chapter", oracle=CONV_UNITS_SQL + """
SELECT book_name, chapter, CAST(0 AS BIGINT) AS seq,
       '# ' || book_name || ' ' || CAST(chapter AS VARCHAR) || chr(10) || chr(10) || '*' ||
       first(testament) || ' Testament, Book ' || CAST(first(book_number) AS VARCHAR) || '*' ||
       chr(10) || chr(10) || '---' || chr(10) || chr(10) AS block
FROM cu GROUP BY book_name, chapter
UNION ALL
SELECT book_name, chapter, CAST(verse AS BIGINT) AS seq,
       '## Verse ' || CAST(verse AS VARCHAR) || chr(10) || chr(10) || '> ' || text ||
       chr(10) || chr(10) || '---' || chr(10) || chr(10) AS block
FROM cu
""")
def q_render_chapter(spark, sf_dir):
    """O-82: chapter documents (vault style) as ordered blocks; no links here."""
    return R.render_chapters(conv_units(spark, sf_dir), None, "vault")


@register("render_patch", oracle=CONV_UNITS_SQL + """
SELECT book_name, chapter, CAST(0 AS BIGINT) AS seq,
       '# ' || book_name || ' Chapter ' || CAST(chapter AS VARCHAR) || chr(10) || chr(10) ||
       '**' || CAST(count(*) AS VARCHAR) || ' verses**' || chr(10) || chr(10) || '---' || chr(10)
       AS block
FROM cu GROUP BY book_name, chapter
UNION ALL
SELECT book_name, chapter, CAST(verse AS BIGINT) AS seq,
       '## Verse ' || CAST(verse AS VARCHAR) || chr(10) || chr(10) || '> ' || text ||
       chr(10) || chr(10) || '---' || chr(10) AS block
FROM cu
""")
def q_render_patch(spark, sf_dir):
    """O-83: the patch style (other header, verse count, no trailing blank line)."""
    return R.render_chapters(conv_units(spark, sf_dir), None, "patch")


def order_units_for_render(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    c = S.table(spark, sf_dir, "customer")
    n = S.table(spark, sf_dir, "nation")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("verse_id"), F.col("n_name").alias("book_name"),
                    F.when(F.col("n_regionkey") < 2, "Old").otherwise("New").alias("testament"),
                    (F.col("n_nationkey") + 1).alias("book_number"),
                    F.col("c_custkey").alias("chapter"), F.col("o_orderkey").alias("verse"),
                    F.concat(F.lit("Order "), "o_orderstatus", F.lit(" "), "o_orderpriority")
                    .alias("text")))


@register("render_linked", oracle=with_(EDGES, """
ou AS (
  SELECT o.o_orderkey AS verse_id, n.n_name AS book_name,
         CASE WHEN n.n_regionkey < 2 THEN 'Old' ELSE 'New' END AS testament,
         n.n_nationkey + 1 AS book_number, c.c_custkey AS chapter, o.o_orderkey AS verse,
         'Order ' || o.o_orderstatus || ' ' || o.o_orderpriority AS text
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey)""", """
rl AS (
  SELECT e.from_id, e.votes, p.p_brand, p.p_size, p.p_partkey,
         row_number() OVER (PARTITION BY e.from_id ORDER BY e.votes DESC, e.to_id) AS rank
  FROM edges e JOIN part p ON p.p_partkey = e.to_id)""", """
lk AS (
  SELECT from_id, string_agg('- [[' || translate(p_brand, ' /:', '__') || '/Chapter_' ||
           CAST(p_size AS VARCHAR) || '#Verse ' || CAST(p_partkey AS VARCHAR) || '|' || p_brand ||
           ' ' || CAST(p_size AS VARCHAR) || ':' || CAST(p_partkey AS VARCHAR) || ']] *(votes: ' ||
           CAST(votes AS VARCHAR) || ')*', chr(10) ORDER BY rank) AS lines
  FROM rl WHERE rank <= 10 GROUP BY from_id)""") + """
SELECT book_name, chapter, CAST(0 AS BIGINT) AS seq,
       '# ' || book_name || ' ' || CAST(chapter AS VARCHAR) || chr(10) || chr(10) || '*' ||
       first(testament) || ' Testament, Book ' || CAST(first(book_number) AS VARCHAR) || '*' ||
       chr(10) || chr(10) || '---' || chr(10) || chr(10) AS block
FROM ou GROUP BY book_name, chapter
UNION ALL
SELECT ou.book_name, ou.chapter, CAST(ou.verse AS BIGINT) AS seq,
       '## Verse ' || CAST(ou.verse AS VARCHAR) || chr(10) || chr(10) || '> ' || ou.text ||
       chr(10) || chr(10) ||
       CASE WHEN lk.lines IS NULL THEN ''
            ELSE '**Cross-References:**' || chr(10) || lk.lines || chr(10) || chr(10) END ||
       '---' || chr(10) || chr(10) AS block
FROM ou LEFT JOIN lk ON lk.from_id = ou.verse_id
""")
def q_render_linked(spark, sf_dir):
    """O-82 with links: customers' orders as chapters, top-10 part links per order."""
    edges = S.link_edges(spark, sf_dir)
    parts = S.part_units(spark, sf_dir)
    t = parts.select(F.col("unit_id").alias("to_id"), "book", "chapter", "verse")
    top = L.top_links_all(edges.join(t, "to_id"), 10)
    nested = L.links_by_key(top, "from_id", ("book", "chapter", "verse", "votes")) \
        .withColumnRenamed("from_id", "verse_id")
    return R.render_chapters(order_units_for_render(spark, sf_dir), nested, "vault")


@register("count_headings", oracle=CONV_UNITS_SQL + """
SELECT book_name, chapter, count(*) AS n_headings FROM cu GROUP BY book_name, chapter
""")
def q_count_headings(spark, sf_dir):
    """O-94: headings counted in the rendered documents."""
    return R.count_headings(R.render_chapters(conv_units(spark, sf_dir), None, "patch"))


@register("render_book_index", oracle=with_(UNITS) + """
, ch AS (SELECT DISTINCT book_name, testament, book_number, chapter FROM units)
SELECT book_name, CAST(0 AS BIGINT) AS seq,
       '# ' || book_name || chr(10) || chr(10) || '**Testament:** ' || first(testament) ||
       chr(10) || '**Book Number:** ' || CAST(first(book_number) AS VARCHAR) || chr(10) ||
       '**Chapters:** ' || CAST(count(*) AS VARCHAR) || chr(10) || chr(10) || '## Chapters' ||
       chr(10) || chr(10) AS block
FROM ch GROUP BY book_name
UNION ALL
SELECT book_name, CAST(chapter AS BIGINT) AS seq,
       '- [[' || translate(book_name, ' /:', '__') || '/Chapter_' || CAST(chapter AS VARCHAR) ||
       '|Chapter ' || CAST(chapter AS VARCHAR) || ']]' || chr(10) AS block
FROM ch
""")
def q_render_book_index(spark, sf_dir):
    """O-84: one index per book listing its chapters in order (as blocks)."""
    return R.book_index(S.doc_units(spark, sf_dir))


@register("render_corpus_index", oracle=with_(UNITS, EDGES) + f"""
, b AS (SELECT DISTINCT source AS book_name, CAST(substr(source, 4) AS INTEGER) + 1 AS book_number,
               CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'Old' ELSE 'New' END
                 AS testament FROM documents)
SELECT 0 AS section, CAST(0 AS BIGINT) AS seq,
       '# {R.CORPUS_TITLE}' || chr(10) || chr(10) || '{R.CORPUS_SUBTITLE}' || chr(10) || chr(10) ||
       '---' || chr(10) || chr(10) || '## Old Testament' || chr(10) || chr(10) AS block
UNION ALL
SELECT 2, CAST(0 AS BIGINT), chr(10) || '## New Testament' || chr(10) || chr(10)
UNION ALL
SELECT CASE WHEN testament = 'Old' THEN 1 ELSE 3 END, CAST(book_number AS BIGINT),
       CAST(book_number AS VARCHAR) || '. [[' || translate(book_name, ' /:', '__') || '/README|' ||
       book_name || ']]' || chr(10)
FROM b
UNION ALL
SELECT 4, CAST(0 AS BIGINT),
       chr(10) || '---' || chr(10) || chr(10) || '## Statistics' || chr(10) || chr(10) ||
       '- **Total Books:** ' || CAST((SELECT count(*) FROM b) AS VARCHAR) || chr(10) ||
       '- **Total Verses:** ' || format('{{:,}}', (SELECT count(*) FROM units)) || chr(10) ||
       '- **Cross-References:** ' || format('{{:,}}', (SELECT count(*) FROM edges)) || chr(10) ||
       chr(10) || '---' || chr(10) || chr(10) || '{R.CORPUS_FOOTER}' || chr(10)
""")
def q_render_corpus_index(spark, sf_dir):
    """O-85: the corpus index with totals (thousands separators, O-89)."""
    books = S.doc_books(spark, sf_dir)
    n_units = S.doc_verses(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    n_links = S.link_edges(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    return R.corpus_index(books, n_units, n_links)


@register("render_report", oracle=with_(UNITS) + """
SELECT book_name, count(DISTINCT chapter) AS n_chapters, count(*) AS n_verses
FROM units GROUP BY book_name
UNION ALL
SELECT NULL, (SELECT count(*) FROM (SELECT DISTINCT book_name, chapter FROM units)), count(*)
FROM units
""")
def q_render_report(spark, sf_dir):
    """O-95: chapters and verses written per book and in total."""
    return R.render_report(S.doc_units(spark, sf_dir))


@register("format_functions", oracle="""
SELECT p_partkey,
       translate(p_name, ' /:', '__') AS safe_name,
       translate(p_name, ' /', '__') AS safe_name_patch,
       '[[' || translate(p_brand, ' /:', '__') || '/Chapter_' || CAST(p_size AS VARCHAR) ||
         '#Verse ' || CAST(p_partkey AS VARCHAR) || '|' || p_brand || ' ' ||
         CAST(p_size AS VARCHAR) || ':' || CAST(p_partkey AS VARCHAR) || ']]' AS link,
       substring(p_name, 1, 20) || '...' AS preview,
       format('{:,}', p_partkey * 1000) AS n_fmt,
       printf('%.2f', p_retailprice) AS price2,
       printf('%.3f', p_retailprice) AS price3
FROM part
""")
def q_format_functions(spark, sf_dir):
    """O-86..O-90: safe names (both versions), link text, preview, number formats."""
    p = S.table(spark, sf_dir, "part")
    return p.select("p_partkey", safe_name("p_name").alias("safe_name"),
                    safe_name("p_name", drop_colon=False).alias("safe_name_patch"),
                    wiki_link("p_brand", "p_size", "p_partkey").alias("link"),
                    preview("p_name", 20).alias("preview"),
                    fmt_int(F.col("p_partkey") * 1000).alias("n_fmt"),
                    fmt_decimal("p_retailprice", 2).alias("price2"),
                    fmt_decimal("p_retailprice", 3).alias("price3"))
