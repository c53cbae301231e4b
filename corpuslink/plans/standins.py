"""

* unit  = non-empty line of ``documents.text``: book = ``source``, chapter =
  ``doc_id``, verse = 1-based line number (empty lines leave holes);
  book number = the number in ``source`` + 1, testament 'Old' below 10.
* link  = ``lineitem`` row: from ``l_orderkey`` to ``l_partkey``, votes =
  ``int(l_quantity)``, arrival order ``(l_linenumber, l_suppkey, l_quantity)``.
* link ends = ``orders`` (book = priority, chapter = customer, verse = order key)
  and ``part`` (book = brand, chapter = size, verse = part key).
* vector = ``embeddings`` row times ``1 + vec_id % 7``: book = ``'book' || label``,
  label < 5 = 'Old'.

Every builder reads whole tables; Catalyst prunes the columns each query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.links import dedupe_edges
from corpuslink.operators.query import units_view

# Fixed stand-in constants (shared with the SQL oracles).
# verse_id = doc_id * stride + line number; a line number is an array place, so below 2^31
LINE_ID_STRIDE = 1 << 32
OLD_BELOW = 10                   # source number below this -> 'Old'
OLD_LABEL_BELOW = 5              # vector label below this -> 'Old'
LINK_ARRIVAL = ("l_linenumber", "l_suppkey", "l_quantity")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source_no():
    return F.substring("source", 4, 100).try_cast("int")


def doc_verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """verses(verse_id, book_id, chapter, verse, text) from document lines."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return d.filter(F.col("line") != "").select(
        (F.col("doc_id") * LINE_ID_STRIDE + F.col("pos") + 1).cast("long").alias("verse_id"),
        (_source_no() + 1).alias("book_id"),
        F.col("doc_id").alias("chapter"),  # bigint: key filters reach the scan
        (F.col("pos") + 1).cast("int").alias("verse"),
        F.col("line").alias("text"))


def doc_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """books(book_id, book_number, book_name, testament, expected_chapters)."""
    src = table(spark, sf_dir, "documents").select("source").distinct()
    n = _source_no()
    return src.select((n + 1).alias("book_id"), (n + 1).alias("book_number"),
                      F.col("source").alias("book_name"),
                      F.when(n < OLD_BELOW, "Old").otherwise("New").alias("testament"),
                      F.lit(None).cast("int").alias("expected_chapters"))


def doc_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units_view(doc_verses(spark, sf_dir), doc_books(spark, sf_dir))


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("from_id"), F.col("l_partkey").alias("to_id"),
                     F.floor("l_quantity").cast("int").alias("votes"), *LINK_ARRIVAL)


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges after the first-wins insert on (from_id, to_id) (O-32)."""
    return dedupe_edges(raw_links(spark, sf_dir), LINK_ARRIVAL)


def order_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("unit_id"), F.col("o_orderpriority").alias("book"),
                    F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("verse"))


def part_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("unit_id"), F.col("p_brand").alias("book"),
                    F.col("p_size").alias("chapter"), F.col("p_partkey").alias("verse"))


def vector_units(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """vectors with unit metadata: (verse_id, book_name, testament, book_number,
    chapter, verse, reference, text, vec). With ``with_text`` the text is the
    whole document with the same id ('' when there is none); otherwise NULL
    (no join)."""
    e = table(spark, sf_dir, "embeddings")
    if with_text:
        d = table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("vec_id"), "text")
        e = e.join(d, "vec_id", "left")
    else:
        e = e.withColumn("text", F.lit(None).cast("string"))
    book = F.concat(F.lit("book"), F.col("label").cast("string"))
    return e.select(
        F.col("vec_id").alias("verse_id"), book.alias("book_name"),
        F.when(F.col("label") < OLD_LABEL_BELOW, "Old").otherwise("New").alias("testament"),
        (F.col("label") + 1).alias("book_number"),
        F.col("label").alias("chapter"), F.col("vec_id").alias("verse"),
        F.concat(book, F.lit(" "), F.col("label").cast("string"), F.lit(":"),
                 F.col("vec_id").cast("string")).alias("reference"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("vec_id") % 7))
        .alias("vec"))
