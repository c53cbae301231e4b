"""Embedding texts and encoders, payload files and streaming ingest
(O-01, O-02, O-07, O-08, O-61..O-63, O-66, O-91, O-92).

The ingest queries land files derived from the tables under the shared
checkpoint folder (a fresh sub-folder per call) and read them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.operators import embed as E
from corpuslink.plans import standins as S
from corpuslink.plans.registry import register
from corpuslink.plans.sql import UNITS, with_
from corpuslink.session import scratch_path, written
from corpuslink.sources.files import write_files
from corpuslink.sources.payloads import read_payloads, write_payloads
from corpuslink.streaming.ingest import compact, read_table, stream_ingest

TEXT_COLS = ("verse_id", "book_number", "chapter", "verse", "strategy", "text")


@register("embedding_texts", oracle=with_(UNITS) + """
SELECT verse_id, book_number, chapter, verse, 'text_only' AS strategy, text FROM units
UNION ALL
SELECT verse_id, book_number, chapter, verse, 'book_context', reference || ' - ' || text FROM units
UNION ALL
SELECT verse_id, book_number, chapter, verse, 'full_context',
       '[' || testament || ' Testament] ' || reference || ' - ' || text FROM units
""")
def q_embedding_texts(spark, sf_dir):
    """O-61: the three text strategies for every unit."""
    return E.embedding_texts(S.doc_units(spark, sf_dir)).select(*TEXT_COLS)


@register("sample_texts", oracle=with_(UNITS) + """
, t AS (
  SELECT verse_id, book_number, chapter, verse, 'text_only' AS strategy, text FROM units
  UNION ALL
  SELECT verse_id, book_number, chapter, verse, 'book_context', reference || ' - ' || text
  FROM units
  UNION ALL
  SELECT verse_id, book_number, chapter, verse, 'full_context',
         '[' || testament || ' Testament] ' || reference || ' - ' || text FROM units)
SELECT strategy, CAST(rank AS INTEGER) AS rank, verse_id, text FROM (
  SELECT *, row_number() OVER (PARTITION BY strategy
                               ORDER BY book_number, chapter, verse, verse_id) AS rank FROM t)
WHERE rank <= 5
""")
def q_sample_texts(spark, sf_dir):
    """O-08: the first five texts of every strategy in corpus order."""
    return E.sample_texts(E.embedding_texts(S.doc_units(spark, sf_dir)), 5) \
        .select("strategy", "rank", "verse_id", "text")


@register("run_metadata", oracle="""
SELECT 'given-embeddings' AS model_name, max(len(embedding)) AS embedding_dim,
       min(len(embedding)) = max(len(embedding)) AS dims_consistent,
       count(DISTINCT vec_id) AS num_verses, 'text_only' AS strategies
FROM embeddings
""")
def q_run_metadata(spark, sf_dir):
    """O-66: run metadata of a vector set (dimension read from the vectors, D1)."""
    v = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("verse_id"), F.lit("text_only").alias("strategy"),
        F.col("embedding").alias("vec"))
    r = E.embedding_run(v, "given-embeddings")
    return r.select("model_name", F.col("embedding_dim").cast("long").alias("embedding_dim"),
                    "dims_consistent", "num_verses",
                    F.array_join("strategies", ",").alias("strategies"))


# A vector as text: its entries in millionths, so that both engines print the same.
HASHED = """
tok AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS t FROM src),
code AS (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {dim} AS slot,
                CASE WHEN CAST('0x' || substr(md5(t), 9, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END
                  AS sign FROM tok),
slots AS (SELECT id, slot, sum(sign) AS v FROM code GROUP BY id, slot),
norms AS (SELECT id, sqrt(sum(v * v)) AS n FROM slots GROUP BY id),
dense AS (
  SELECT s.id, list(CASE WHEN n.n > 0 THEN coalesce(x.v, 0) / n.n ELSE 0 END ORDER BY d.slot)
           AS vec
  FROM src s CROSS JOIN (SELECT unnest(range({dim})) AS slot) d
  LEFT JOIN norms n ON n.id = s.id LEFT JOIN slots x ON x.id = s.id AND x.slot = d.slot
  GROUP BY s.id)
"""


def millionths(vec: str = "vec"):
    """Halves go away from zero, as ``round`` has them; a float's millionths plus a half are exact.
    Most entries are zero, and ``round`` would make a decimal of each."""
    def text(x):
        size = F.floor(F.abs(x.cast("double")) * 1e6 + 0.5)
        return F.when(x == 0, "0").otherwise(F.when(x < 0, -size).otherwise(size).cast("string"))
    return F.array_join(F.transform(vec, text), ",").alias(vec)


@register("hash_encode", oracle=with_(UNITS, """
src AS (
  SELECT verse_id || '/text_only' AS id, verse_id, 'text_only' AS strategy, text FROM units
  UNION ALL SELECT verse_id || '/book_context', verse_id, 'book_context',
                   reference || ' - ' || text FROM units
  UNION ALL SELECT verse_id || '/full_context', verse_id, 'full_context',
                   '[' || testament || ' Testament] ' || reference || ' - ' || text FROM units)
""", HASHED.format(dim=64)) + """
SELECT verse_id, strategy, array_to_string(list_transform(vec, lambda x: CAST(round(
         CAST(CAST(x AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT)), ',') AS vec
FROM dense JOIN src USING (id)
""")
def q_hash_encode(spark, sf_dir):
    """O-62/O-63: feature-hashing vectors for all three strategies."""
    texts = E.embedding_texts(S.doc_units(spark, sf_dir))
    return E.encode(texts, dim=64).select("verse_id", "strategy", millionths())


@register("pandas_encode", oracle=with_(UNITS) + """
, low AS (SELECT verse_id, lower(text) AS t FROM units),
f AS (SELECT verse_id, list_transform(range(97, 123), lambda c:
        length(t) - length(replace(t, chr(CAST(c AS INTEGER)), ''))) AS v FROM low)
SELECT verse_id, 'text_only' AS strategy, array_to_string(list_transform(v, lambda x:
         CASE WHEN list_sum(v) = 0 THEN 0 ELSE CAST(round(CAST(CAST(x / sqrt(list_sum(
           list_transform(v, lambda y: y * y))) AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) END),
         ',') AS vec
FROM f
""")
def q_pandas_encode(spark, sf_dir):
    """O-92: a pluggable model (letter frequencies) through an iterator pandas UDF."""
    texts = E.embedding_texts(S.doc_units(spark, sf_dir), ["text_only"])
    return E.encode(texts, encoder=E.letter_profile_model, dim=26, batch=256) \
        .select("verse_id", "strategy", millionths())


@register("text_query_search", oracle=with_("""
src AS (SELECT 'd' || doc_id AS id, doc_id, CAST(NULL AS BIGINT) AS item_id, text FROM documents
        UNION ALL SELECT 'q' || item_id, NULL, item_id, text FROM benchmark)
""", HASHED.format(dim=64)) + """
, v AS (SELECT * FROM dense JOIN src USING (id))
SELECT qid, CAST(rank AS INTEGER) AS rank, verse_id, score FROM (
  SELECT q.item_id AS qid, d.doc_id AS verse_id,
         round(list_dot_product(CAST(d.vec AS DOUBLE[]), CAST(q.vec AS DOUBLE[])), 3) AS score,
         row_number() OVER (PARTITION BY q.item_id ORDER BY round(list_dot_product(
           CAST(d.vec AS DOUBLE[]), CAST(q.vec AS DOUBLE[])), 6) DESC, d.doc_id) AS rank
  FROM v d, v q WHERE d.doc_id IS NOT NULL AND q.item_id IS NOT NULL)
WHERE rank <= 3
""")
def q_text_query_search(spark, sf_dir):
    """Text queries (the benchmark's questions) against all documents, both through the
    same encoder; scores compare at 3 places."""
    from corpuslink.operators.qa import search_text_queries
    units = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("verse_id"), "text")
    asked = S.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return search_text_queries(units, asked, 3, dim=64).withColumn("score", F.round("score", 3))


def _land_payloads(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    units = c.select((F.floor(F.col("conv_id") / 10) + 1).cast("int").alias("book_number"),
                     F.col("conv_id").cast("int").alias("chapter"),
                     (F.col("turn") + 1).alias("verse"), "text")
    path = scratch_path(spark, f"payloads-{uuid.uuid4().hex}")
    write_payloads(units, path)
    return path


@register("payload_ingest", oracle="""
SELECT CAST(conv_id // 10 + 1 AS INTEGER) AS book_number, CAST(conv_id AS INTEGER) AS chapter,
       turn + 1 AS verse, trim(text) AS text
FROM conversations WHERE trim(text) <> ''
""")
def q_payload_ingest(spark, sf_dir):
    """O-01: landed chapter payloads read back (strip, drop blank / verse 0)."""
    return read_payloads(spark, _land_payloads(spark, sf_dir), "fetch")


@register("payload_backfill", oracle="""
SELECT CAST(conv_id // 10 + 1 AS INTEGER) AS book_number, CAST(conv_id AS INTEGER) AS chapter,
       turn + 1 AS verse, text
FROM conversations WHERE text <> ''
""")
def q_payload_backfill(spark, sf_dir):
    """O-02: the backfill reading of the same payloads (text kept as is)."""
    return read_payloads(spark, _land_payloads(spark, sf_dir), "backfill")


EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
CHUNKS = 4


def epoch_us():
    """Microseconds since the epoch of a TIMESTAMP_NTZ ``ts``, independent of the
    session time zone."""
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")


@register("stream_ingest", oracle="""
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
""")
def q_stream_ingest(spark, sf_dir):
    """O-91: events landed in four time slices, ingested by a file stream with
    first-wins policy, the first batch folded into a snapshot; equals the batch
    first-wins result."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    ev = S.table(spark, sf_dir, "events").withColumn("_us", epoch_us())
    lo, hi = ev.agg(F.min("_us")).scalar(), ev.agg(F.max("_us")).scalar()
    sliced = ev.withColumn("_slice", F.floor((F.col("_us") - lo) * CHUNKS / (hi - lo + 1)))
    # Slices are landed one after another so that files arrive in time order.
    for i in range(CHUNKS):
        sliced.filter(F.col("_slice") == i).select(*EVENT_SCHEMA.fieldNames()) \
            .write.mode("overwrite").json(f"{base}/landing/slice={i}")
    q = stream_ingest(spark, f"{base}/landing/*", f"{base}/table", f"{base}/checkpoint",
                      EVENT_SCHEMA, max_files=8)
    q.awaitTermination()
    key = (["user_id", "event_type"], ["event_id"], "ignore")
    compact(spark, f"{base}/table", EVENT_SCHEMA, *key, upto=0)
    return read_table(spark, f"{base}/table", EVENT_SCHEMA, *key)


@register("ledger_ids", oracle="""
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
e AS (SELECT user_id, event_type, event_id, value,
             (epoch_us(ts) - lo) * 4 // (hi - lo + 1) AS slice FROM events, b),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                                 ORDER BY slice, event_id) = 1)
SELECT user_id, event_type, event_id, value, row_number() OVER (ORDER BY slice, event_id) AS id
FROM f
""")
def q_ledger_ids(spark, sf_dir):
    """O-13, O-10 over batches: events in four time slices, inserted first-wins with dense ids;
    one batch runs twice, another stops after its ids were reserved and runs again."""
    from corpuslink.streaming.ingest import apply_batch_with_ids, reserve_ids
    target = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    ev = S.table(spark, sf_dir, "events").withColumn("_us", epoch_us())
    lo, hi = ev.agg(F.min("_us")).scalar(), ev.agg(F.max("_us")).scalar()
    sliced = ev.withColumn("_slice", F.floor((F.col("_us") - lo) * CHUNKS / (hi - lo + 1)))
    keys, order = ["user_id", "event_type"], ["event_id"]

    def run(i):
        apply_batch_with_ids(sliced.filter(F.col("_slice") == i), i, target, EVENT_SCHEMA, keys,
                             order)
    for i in range(CHUNKS):
        run(i)
        if i == 1:
            run(0)                                   # an earlier batch again
        if i == 2:                                   # the reservation is found, not made anew
            n = spark.read.parquet(f"{target}/batches/batch={i}").count()
            reserve_ids(spark, f"{target}/ledger", i, n)
            run(i)
    full = T.StructType([*EVENT_SCHEMA.fields, T.StructField("id", T.LongType())])
    return read_table(spark, target, full, keys, order)


BATCH_FILES, BATCHES = 40, 25      # files of a batch at least, batches of a backlog at most


@register("quarantine", oracle="""
WITH f AS (SELECT CAST(conv_id // 10 + 1 AS INTEGER) AS book_number, CAST(conv_id AS INTEGER) AS chapter,
                  count(*) FILTER (WHERE trim(text) <> '') AS n,
                  CASE WHEN conv_id % 7 = 2 THEN 'not a list' WHEN conv_id % 5 = 1 THEN 'broken JSON'
                       WHEN conv_id % 11 = 3 OR count(*) FILTER (WHERE trim(text) <> '') = 0
                       THEN 'no usable verse' END AS reason
           FROM conversations GROUP BY conv_id)
SELECT how, book_number, chapter, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_rows, reason
FROM f, (SELECT unnest(['batch', 'stream']) AS how)
UNION ALL SELECT how, NULL, NULL, 0, 'no chapter in the name'
FROM (SELECT unnest(['batch', 'stream']) AS how)
""")
def q_quarantine(spark, sf_dir):
    """O-01, O-91: every conversation landed as a payload file, some cut off, some no list, some
    empty, one misnamed; read as a batch and as a stream, each file is in the rows or, with the
    reason, in the quarantine."""
    from corpuslink.sources.payloads import PLACE_PATTERN, quarantined_payloads
    from corpuslink.streaming.ingest import PAYLOAD_ROWS, read_quarantine, stream_payloads
    base = scratch_path(spark, f"quarantine-{uuid.uuid4().hex}")
    c = S.table(spark, sf_dir, "conversations")
    files = c.groupBy("conv_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(
        (F.col("turn") + 1).alias("verse"), "text")))).alias("good"))
    value = F.when(F.col("conv_id") % 7 == 2, F.concat(F.lit('{"verses": '), "good", F.lit("}"))) \
        .when(F.col("conv_id") % 5 == 1, F.expr("left(good, length(good) - 3)")) \
        .when(F.col("conv_id") % 11 == 3, F.lit("[]")).otherwise(F.col("good"))
    write_files(files.select((F.floor(F.col("conv_id") / 10) + 1).cast("int").alias("book_number"),
                             F.col("conv_id").cast("int").alias("chapter"), value.alias("value")),
                f"{base}/landing/chapters", ["book_number", "chapter"], "value")
    spark.createDataFrame([("[]",)], "value string").coalesce(1).write.text(f"{base}/landing/other")
    landing = f"{base}/landing"

    def report(how, rows, bad):
        got = rows.groupBy("book_number", "chapter").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
            "reason", F.lit(None).cast("string"))
        lost = bad.select(*[F.regexp_extract("file", PLACE_PATTERN, i).try_cast("int").alias(n)
                            for i, n in ((1, "book_number"), (2, "chapter"))],
                          F.lit(0).cast("long").alias("n_rows"), "reason")
        return got.union(lost).select(F.lit(how).alias("how"), "*")

    # A batch costs its fixed seconds whatever it holds, so batches grow with what has landed.
    each = max(BATCH_FILES, -(-c.select("conv_id").distinct().count() // BATCHES))
    stream_payloads(spark, landing, f"{base}/table", f"{base}/checkpoint", max_files=each) \
        .awaitTermination()
    streamed = read_table(spark, f"{base}/table", PAYLOAD_ROWS,
                          ["book_number", "chapter", "verse"], ["text"])
    return report("batch", read_payloads(spark, landing), quarantined_payloads(spark, landing)).union(
        report("stream", streamed, read_quarantine(spark, f"{base}/table")))


# ------------------------------------------------------------- sinks etc. ---

@register("book_table", oracle="""
SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS book_id,
       CAST(n_nationkey AS INTEGER) AS book_number, n_name AS book_name, r_name AS testament,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_nationkey AS INTEGER) END
         AS expected_chapters
FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def q_book_table(spark, sf_dir):
    """O-04: the book dimension from a table (here the nations)."""
    from corpuslink.sources.books import books_from
    n = S.table(spark, sf_dir, "nation").join(S.table(spark, sf_dir, "region"),
                                              F.col("r_regionkey") == F.col("n_regionkey"))
    return books_from(n.select(
        F.col("n_nationkey").alias("book_number"), F.col("n_name").alias("book_name"),
        F.col("r_name").alias("testament"), F.when(F.col("n_nationkey") % 4 != 0, F.col(
            "n_nationkey")).alias("expected_chapters")))


@register("table_roundtrip", oracle=with_(UNITS) + """
SELECT verse_id, book_name, testament, book_number, chapter, verse, text, reference FROM units
""")
def q_table_roundtrip(spark, sf_dir):
    """O-04..O-06: books and verses saved as tables (create-or-replace) and
    loaded back through the verse export scan."""
    from corpuslink.sources.books import load_verses
    from corpuslink.sources.sinks import save_tables
    path = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    save_tables({"books": S.doc_books(spark, sf_dir), "verses": S.doc_verses(spark, sf_dir)},
                path)
    v = spark.read.parquet(f"{path}/verses")
    b = spark.read.parquet(f"{path}/books")
    return load_verses(v, b).select("verse_id", "book_name", "testament", "book_number",
                                    "chapter", "verse", "text", "reference")


@register("embedding_sink", oracle="""
SELECT 'given-embeddings' AS model_name, max(len(embedding)) AS embedding_dim,
       count(DISTINCT vec_id) AS num_verses, 'book_context,text_only' AS strategies,
       2 * count(*) AS n_vectors
FROM embeddings
""")
def q_embedding_sink(spark, sf_dir):
    """O-07/O-63: vectors of two strategies saved partitioned by strategy with
    their run metadata, read back."""
    from corpuslink.sources.sinks import save_embeddings
    e = S.table(spark, sf_dir, "embeddings")
    vecs = e.select(F.col("vec_id").alias("verse_id"),
                    F.explode(F.array(F.lit("text_only"), F.lit("book_context"))).alias("strategy"),
                    F.col("embedding").alias("vec"))
    path = scratch_path(spark, f"emb-{uuid.uuid4().hex}")
    save_embeddings(vecs, path, "given-embeddings")
    meta = spark.read.parquet(f"{path}/metadata")
    n = spark.read.parquet(f"{path}/vectors").agg(F.count(F.lit(1))).scalar()
    return meta.withColumn("n_vectors", n).select(
        "model_name", F.col("embedding_dim").cast("long").alias("embedding_dim"), "num_verses",
        F.array_join("strategies", ",").alias("strategies"), "n_vectors")


@register("document_sink", oracle="""
SELECT 'Book ' || CAST(conv_id // 10 AS VARCHAR) AS book_name, conv_id AS chapter,
       '# Book ' || CAST(conv_id // 10 AS VARCHAR) || ' Chapter ' || CAST(conv_id AS VARCHAR) ||
       chr(10) || chr(10) || '**' || CAST(count(*) AS VARCHAR) || ' verses**' || chr(10) ||
       chr(10) || '---' || chr(10) || chr(10) ||
       string_agg('## Verse ' || CAST(turn + 1 AS VARCHAR) || chr(10) || chr(10) || '> ' ||
                  text || chr(10) || chr(10) || '---' || chr(10), chr(10) ORDER BY turn)
       AS content
FROM conversations GROUP BY conv_id
""")
def q_document_sink(spark, sf_dir):
    """O-09 + O-83: patch documents written as a tree, one file per chapter, and read
    back; a chapter in more than one file would come back as more than one row."""
    from corpuslink.operators import render as R
    from corpuslink.plans.catalog_text import conv_units
    from corpuslink.sources.sinks import read_tree, write_tree
    path = scratch_path(spark, f"docs-{uuid.uuid4().hex}")
    units = conv_units(spark, sf_dir)
    write_tree(R.render_chapters(units, None, "patch"), path, style="patch",
               book_index=R.book_index(units))
    docs = read_tree(spark, path).filter(F.col("document").startswith("Chapter_"))
    return docs.select(F.col("folder").alias("book_name"), F.regexp_extract(
        "document", r"^Chapter_(\d+)\.md$", 1).cast("long").alias("chapter"), "content")


@register("document_tree", oracle="""
WITH ch AS (SELECT DISTINCT 'Book ' || CAST(conv_id // 10 AS VARCHAR) AS b, conv_id FROM conversations)
SELECT b AS folder, 'README.md' AS document, 1 AS n_files, count(*) AS n_links FROM ch GROUP BY b
UNION ALL SELECT '', 'README.md', 1, count(DISTINCT b) FROM ch
UNION ALL SELECT b, 'Chapter_' || CAST(conv_id AS VARCHAR) || '.md', 1, 0 FROM ch
""")
def q_document_tree(spark, sf_dir):
    """O-09, O-84, O-85: the whole tree - chapters, a README per book and one of the corpus -
    with the links each index holds."""
    from corpuslink.operators import render as R
    from corpuslink.plans.catalog_text import conv_units
    from corpuslink.sources.sinks import read_tree, write_tree
    path = scratch_path(spark, f"tree-{uuid.uuid4().hex}")
    units = conv_units(spark, sf_dir)
    books = units.select("book_name", "testament", "book_number").distinct()
    one = units.agg(F.count(F.lit(1)).alias("n"))
    write_tree(R.render_chapters(units, None, "patch"), path, style="patch",
               book_index=R.book_index(units),
               corpus_index=R.corpus_index(books, one, one.select(F.lit(0).cast("long").alias("n"))))
    docs = read_tree(spark, path)
    return docs.select("folder", "document", "n_files", F.when(
        F.col("document") == "README.md", F.regexp_count("content", F.lit(r"\[\["))).otherwise(0)
        .cast("long").alias("n_links"))


@register("backfill_render", oracle="""
WITH conv AS (SELECT conv_id, turn, text, conv_id % 3 = 0 AS late FROM conversations WHERE text <> '')
SELECT 'Book ' || CAST(conv_id // 10 AS VARCHAR) AS folder,
       'Chapter_' || CAST(conv_id AS VARCHAR) || '.md' AS document, count(*) AS n_headings
FROM conv WHERE late GROUP BY conv_id
""")
def q_backfill_render(spark, sf_dir):
    """O-58, O-02, O-60, O-83 end to end: chapters missing from the table (every third) are
    found as gaps, their payload files read and loaded, and only they rendered again."""
    from corpuslink.operators import quality as Q
    from corpuslink.operators import render as R
    from corpuslink.sources.sinks import read_tree, write_tree
    base = scratch_path(spark, f"repair-{uuid.uuid4().hex}")
    # every file is opened once; the gaps, the load and the rendering read one table
    payloads = written(read_payloads(spark, _land_payloads(spark, sf_dir), "backfill").select(
        F.col("book_number"), F.col("chapter"), F.col("verse").cast("long").alias("verse"), "text"),
        "payload-rows")
    known = payloads.filter(F.col("chapter") % 3 != 0)
    wanted = S.table(spark, sf_dir, "conversations").select(
        (F.floor(F.col("conv_id") / 10) + 1).cast("int").alias("book_number"),
        F.col("conv_id").cast("int").alias("chapter")).distinct().join(
        known.select("book_number", "chapter"), ["book_number", "chapter"], "left_anti")
    table = Q.backfill(known, payloads, wanted, ["book_number", "chapter", "verse"], ["text"])
    again = table.join(wanted, ["book_number", "chapter"], "left_semi").select(
        F.concat(F.lit("Book "), (F.col("book_number") - 1).cast("string")).alias("book_name"),
        F.lit("Old").alias("testament"), "book_number", "chapter", "verse",
        F.col("chapter").cast("long").alias("verse_id"), "text")
    write_tree(R.render_chapters(again, None, "patch"), base, style="patch")
    return read_tree(spark, base).select("folder", "document", F.regexp_count(
        "content", F.lit("## Verse ")).cast("long").alias("n_headings"))


@register("patch_tree", oracle="""
WITH conv AS (
  SELECT 'Book ' || CAST(conv_id // 10 AS VARCHAR) AS b, conv_id // 10 AS n, conv_id, turn, text,
         conv_id % 3 = 0 AND conv_id // 10 % 2 = 0 AS late FROM conversations WHERE text <> ''),
ch AS (SELECT DISTINCT b, n, conv_id, late FROM conv)
SELECT b AS folder, 'Chapter_' || CAST(conv_id AS VARCHAR) || '.md' AS document,
       CASE WHEN late THEN '# ' || b || ' Chapter ' || CAST(conv_id AS VARCHAR) || chr(10) ||
         chr(10) || '**' || CAST(count(*) AS VARCHAR) || ' verses**' || chr(10) || chr(10) ||
         '---' || chr(10) || chr(10)
       ELSE '# ' || b || ' ' || CAST(conv_id AS VARCHAR) || chr(10) || chr(10) ||
         '*Old Testament, Book ' || CAST(n + 1 AS VARCHAR) || '*' || chr(10) || chr(10) || '---' ||
         chr(10) || chr(10) END ||
       left(string_agg('## Verse ' || CAST(turn + 1 AS VARCHAR) || chr(10) || chr(10) || '> ' ||
         text || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY turn),
         CASE WHEN late THEN -1 ELSE 1000000000 END) AS content,
       late AS rewritten
FROM conv GROUP BY b, n, conv_id, late
UNION ALL
SELECT b, 'README.md', '# ' || b || chr(10) || chr(10) || '**Testament:** Old' || chr(10) ||
       '**Book Number:** ' || CAST(n + 1 AS VARCHAR) || chr(10) || '**Chapters:** ' ||
       CAST(count(*) AS VARCHAR) || chr(10) || chr(10) || '## Chapters' || chr(10) || chr(10) ||
       string_agg('- [[' || replace(b, ' ', '_') || '/Chapter_' || CAST(conv_id AS VARCHAR) ||
                  '|Chapter ' || CAST(conv_id AS VARCHAR) || ']]' || chr(10), '' ORDER BY conv_id),
       bool_or(late)
FROM ch GROUP BY b, n
""")
def q_patch_tree(spark, sf_dir):
    """O-58, O-02, O-60, O-83 in place: a finished tree lacks every third chapter of every
    other book; the gaps are found, loaded from their payload files and rendered into that tree
    with the indexes of their books. All documents afterwards, and whether their file is
    another than before (by its name and time of change)."""
    from corpuslink.operators import quality as Q
    from corpuslink.operators import render as R
    from corpuslink.sources.sinks import read_tree, repair_tree, tree_files, write_tree
    base = scratch_path(spark, f"patch-{uuid.uuid4().hex}")
    # every file is opened once, as in backfill_render
    payloads = written(read_payloads(spark, _land_payloads(spark, sf_dir), "backfill").select(
        "book_number", "chapter", F.col("verse").cast("long").alias("verse"), "text"),
        "payload-rows")
    known = payloads.where("chapter % 3 <> 0 OR book_number % 2 = 0")

    def units(rows):
        return rows.select(
            F.concat(F.lit("Book "), (F.col("book_number") - 1).cast("string")).alias("book_name"),
            F.lit("Old").alias("testament"), "book_number", "chapter", "verse",
            F.col("chapter").cast("long").alias("verse_id"), "text")

    write_tree(R.render_chapters(units(known), None, "vault"), f"{base}/tree",
               book_index=R.book_index(units(known)))
    tree_files(spark, f"{base}/tree").write.parquet(f"{base}/before")
    wanted = payloads.select("book_number", "chapter").distinct().join(
        known.select("book_number", "chapter"), ["book_number", "chapter"], "left_anti")
    table = Q.backfill(known, payloads, wanted, ["book_number", "chapter", "verse"], ["text"])
    repair_tree(units(table), wanted.select(F.concat(F.lit("Book "), (
        F.col("book_number") - 1).cast("string")).alias("book_name"), "chapter"), f"{base}/tree")
    keys = ["folder", "document", "file", "modified"]
    same = tree_files(spark, f"{base}/tree").join(
        spark.read.parquet(f"{base}/before"), keys, "left_semi").select(
        "folder", "document", F.lit(False).alias("rewritten"))
    return read_tree(spark, f"{base}/tree").join(same, ["folder", "document"], "left").select(
        "folder", "document", "content", F.coalesce("rewritten", F.lit(True)).alias("rewritten"))


@register("backfill", oracle="""
WITH c AS (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * 500 // 1000 AS cut
           FROM events),
ev AS (SELECT e.user_id, e.event_type, e.event_id, e.value, epoch_us(e.ts) <= c.cut AS old
       FROM events e, c),
tgt AS (SELECT user_id, event_type, event_id, value FROM ev WHERE old
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1),
wanted AS (SELECT DISTINCT event_type FROM ev WHERE NOT old AND value > 50),
bat AS (SELECT user_id, event_type, event_id, value FROM ev
        WHERE NOT old AND event_type IN (SELECT event_type FROM wanted)
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
SELECT t.user_id, t.event_type, t.event_id, t.value FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM bat b WHERE b.user_id = t.user_id AND b.event_type = t.event_type)
UNION ALL SELECT * FROM bat
""")
def q_backfill(spark, sf_dir):
    """O-60: only the wanted groups (here: event types that saw a value > 50 in
    the later half) are reloaded from the later events, last wins."""
    from corpuslink.operators.quality import backfill
    from corpuslink.plans.catalog_upsert import COLS, KEYS, ORDER, _split
    target, batch = _split(spark, sf_dir)
    wanted = batch.filter(F.col("value") > 50).select("event_type").distinct()
    return backfill(target, batch.select(*COLS), wanted, KEYS, ORDER)


@register("index_roundtrip", oracle="""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
cent AS (
  SELECT label AS qid, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS i FROM v)
    GROUP BY label, i) GROUP BY label),
centn AS (SELECT qid, list_transform(c, lambda x: x / n) AS qv FROM (
  SELECT qid, c, sqrt(list_sum(list_transform(c, lambda y: y * y))) AS n FROM cent)),
vn AS (SELECT vec_id, list_transform(vec, lambda x: x / n) AS vec FROM (
  SELECT vec_id, vec, sqrt(list_sum(list_transform(vec, lambda y: y * y))) AS n FROM v))
SELECT qid, CAST(rank AS INTEGER) AS rank, verse_id, score FROM (
  SELECT c.qid, vn.vec_id AS verse_id, round(list_dot_product(vn.vec, c.qv), 4) AS score,
         row_number() OVER (PARTITION BY c.qid
                            ORDER BY round(list_dot_product(vn.vec, c.qv), 4) DESC, vn.vec_id)
           AS rank
  FROM vn, centn c)
WHERE rank <= 3
""")
def q_index_roundtrip(spark, sf_dir):
    """O-69: build the IVF index, persist it (normalised float vectors clustered by cell),
    load it and search all cells; the stored vectors are float, so scores compare at 4
    places."""
    from corpuslink.operators import index_store as I
    from corpuslink.operators import vector as V
    from corpuslink.functions.vectors import l2_normalize
    e = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("verse_id"), F.col("embedding").alias("vec"), "label")
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    idx = V.build_ivf(e.select("verse_id", "vec"), nlist=4, target_recall=None)
    I.save_index(idx, path, "text_only")
    if I.load_index(spark, path, "full_context") is not None:  # never saved
        raise AssertionError("a missing strategy must be skipped")
    loaded = I.load_index(spark, path, "text_only")
    q = V.centroids(e, "label").select(F.col("label").alias("qid"),
                                       l2_normalize("centroid").alias("qvec"))
    r = V.topk_ann(loaded, q, 3, nprobe=4)
    # Re-rank at the stored precision (float vectors).
    return r.withColumn("score", F.round("score", 4)).select("qid", "rank", "verse_id", "score")


@register("index_updates", oracle="""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
cent AS (
  SELECT label AS qid, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS i FROM v)
    GROUP BY label, i) GROUP BY label),
centn AS (SELECT qid, list_transform(c, lambda x: x / n) AS qv FROM (
  SELECT qid, c, sqrt(list_sum(list_transform(c, lambda y: y * y))) AS n FROM cent)),
live AS (SELECT vec_id, CASE WHEN vec_id % 10 = 4 THEN -1 ELSE 1 END AS s, vec FROM v
         WHERE vec_id % 10 <> 7 OR vec_id % 3 = 1),
vn AS (SELECT vec_id, list_transform(vec, lambda x: s * x / n) AS vec FROM (
  SELECT *, sqrt(list_sum(list_transform(vec, lambda y: y * y))) AS n FROM live))
SELECT stage, qid, CAST(rank AS INTEGER) AS rank, verse_id, score
FROM (SELECT unnest(['changed', 'folded']) AS stage), (
  SELECT c.qid, vn.vec_id AS verse_id, round(list_dot_product(vn.vec, c.qv), 4) AS score,
         row_number() OVER (PARTITION BY c.qid
                            ORDER BY round(list_dot_product(vn.vec, c.qv), 4) DESC, vn.vec_id)
           AS rank
  FROM vn, centn c)
WHERE rank <= 3
""")
def q_index_updates(spark, sf_dir):
    """O-69 over time: two thirds of the vectors saved, the rest appended, every tenth deleted,
    some of those appended again, another tenth replaced by their opposites; searched in all
    cells before and after folding."""
    from corpuslink.operators import index_store as I
    from corpuslink.operators import vector as V
    from corpuslink.functions.vectors import l2_normalize
    e = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("verse_id"), F.col("embedding").cast("array<double>").alias("vec"),
        "label")
    vecs = e.select("verse_id", "vec")
    cells = V.centroids(V.normalize(e), "label").select(
        F.col("label").cast("long").alias("cell"), "centroid")
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    I.save_index(V.ivf_from_cells(vecs.where("verse_id % 3 <> 0"), cells, None), path)
    I.append_vectors(spark, path, vecs.where("verse_id % 3 = 0"))
    I.delete_vectors(spark, path, vecs.where("verse_id % 10 = 7"))
    I.append_vectors(spark, path, vecs.where("verse_id % 10 = 7 AND verse_id % 3 = 1"))
    I.append_vectors(spark, path, vecs.where("verse_id % 10 = 4").withColumn(
        "vec", F.transform("vec", lambda x: -x)))
    q = V.centroids(e, "label").select(F.col("label").alias("qid"),
                                       l2_normalize("centroid").alias("qvec"))
    n = cells.count()

    def found(stage):
        top = V.topk_ann(I.load_index(spark, path), q, 3, nprobe=n)
        return top.select(F.lit(stage).alias("stage"), "qid", "rank", "verse_id",
                          F.round("score", 4).alias("score"))
    before = found("changed")
    I.fold_index(spark, path)
    return before.union(found("folded"))
