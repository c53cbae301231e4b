"""Sinks (O-06, O-07, O-09): Parquet tables, embeddings and documents.

Every write is one atomic job per table (overwrite), replacing the
reference's delete-and-recreate of a database file and its per-book commits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.embed import embedding_run
from corpuslink.sources.files import NO_VALUE, list_files, move_files, read_files, seen_files, \
    write_files


def save_tables(tables: dict[str, DataFrame], path: str) -> None:
    """O-06: create-or-replace every table under ``path/<name>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def save_embeddings(vecs: DataFrame, path: str, model_name: str) -> None:
    """O-07: vectors partitioned by strategy plus the one-row run metadata."""
    vecs.select("verse_id", "strategy", "vec").write.mode("overwrite") \
        .partitionBy("strategy").parquet(f"{path}/vectors")
    embedding_run(vecs, model_name).write.mode("overwrite").parquet(f"{path}/metadata")


def _body(style: str):
    """A block as the writer's line: without its last line feed, which the writer adds."""
    body = F.expr("left(block, length(block) - 1)")
    if style == "patch":
        # The patch style joins blocks with '\n'; carry it on every later block.
        body = F.when(F.col("seq") == 0, body).otherwise(F.concat(F.lit("\n"), body))
    return body


def write_documents(blocks: DataFrame, path: str, keys=("book_name", "chapter"),
                    style: str = "vault") -> None:
    """O-09: documents as folders of part files, from ordered blocks.

    Blocks are range-partitioned on (document, seq) and sorted inside each
    task, then written as text lines: a document's folder holds one or more
    part files whose name order is the block order, so a huge document is
    split across writers instead of landing in one task, and no document is
    ever built as a single value. The target tree is replaced.
    """
    keys = list(keys)
    (blocks.withColumn("block", _body(style)).repartitionByRange(*keys, "seq")
     .sortWithinPartitions(*keys, "seq")
     .select(*keys, "block").write.mode("overwrite").partitionBy(*keys)
     .option("lineSep", "\n").text(path))


def _documents(chapters: DataFrame, style: str, book_index: DataFrame | None = None,
               corpus_index: DataFrame | None = None) -> DataFrame:
    """(folder, document, section, seq, block) of chapters and indexes."""
    parts = [chapters.select(F.col("book_name").alias("folder"), F.concat(
        F.lit("Chapter_"), F.col("chapter").cast("string"), F.lit(".md")).alias("document"),
        F.lit(0).alias("section"), "seq", _body(style).alias("block"))]
    if book_index is not None:
        parts.append(book_index.select(F.col("book_name").alias("folder"), F.lit("README.md").alias(
            "document"), F.lit(0).alias("section"), "seq", _body("vault").alias("block")))
    if corpus_index is not None:
        parts.append(corpus_index.select(F.lit(None).cast("string").alias("folder"), F.lit(
            "README.md").alias("document"), "section", "seq", _body("vault").alias("block")))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole


def write_tree(chapters: DataFrame, path: str, style: str = "vault",
               book_index: DataFrame | None = None, corpus_index: DataFrame | None = None
               ) -> None:
    """O-09, O-84, O-85: the document tree, one text file per document; what was there goes.

    Document ``Chapter_n.md`` or ``README.md`` of a book's folder is written as
    ``folder=<Book>/document=<name>/part-*``: the file systems' writers choose part names,
    so the document's name is its folder's. A document is streamed block by block into its
    one file; documents spread over the tasks. The corpus index lies in folder ``''``
    (Spark's default partition), which ``read_tree`` gives back as such.
    """
    write_files(_documents(chapters, style, book_index, corpus_index), path,
                ["folder", "document"], "block", ["section", "seq"])


def patch_tree(chapters: DataFrame, path: str, style: str = "patch",
               book_index: DataFrame | None = None) -> None:
    """O-60, O-83: replace or add the given documents in a tree that ``write_tree`` made.

    The tasks write the documents into a folder beside the tree and then, when all are done, move
    each into its own folder there, over the old file; no other file is read, copied or touched,
    and the driver holds no document's name. Running it again gives the same tree, so a patch that
    stopped between two documents is completed by repeating it.
    """
    spark = chapters.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    tree = hadoop.Path(path)
    system = tree.getFileSystem(spark._jsc.hadoopConfiguration())
    tree = system.makeQualified(tree)
    patch = hadoop.Path(tree.getParent(), f"_patch-{uuid.uuid4().hex}")
    write_files(_documents(chapters, style, book_index), patch.toString(),
                ["folder", "document"], "block", ["section", "seq"])
    move_files(spark, patch.toString(), tree.toString())
    system.delete(patch, True)


def repair_tree(units: DataFrame, wanted: DataFrame, path: str, links: DataFrame | None = None,
                style: str = "patch") -> None:
    """O-60: render the ``wanted`` (book_name, chapter) again from ``units`` and the index of
    their books, into the tree at ``path``. A wanted chapter without units changes nothing;
    books of other chapters keep their files."""
    from corpuslink.operators.render import book_index, render_chapters
    wanted = wanted.select("book_name", "chapter").distinct()
    chapters = units.join(wanted, ["book_name", "chapter"], "left_semi")
    books = units.join(chapters.select("book_name").distinct(), "book_name", "left_semi")
    patch_tree(render_chapters(chapters, links, style), path, style, book_index(books))


DOCUMENT_PLACE = "/folder=([^/]*)/document=([^/]*)/([^/]*)$"


def _named(listed: DataFrame) -> DataFrame:
    """A tree's listing with folder and document, as their folders' names have them."""
    def value(group):
        raw = F.regexp_extract("place", DOCUMENT_PLACE, group)
        # a plus sign stands for itself
        return F.when(raw != NO_VALUE, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))
    return seen_files(listed).where(F.regexp_like("place", F.lit(DOCUMENT_PLACE))).withColumns({
        "folder": F.coalesce(value(1), F.lit("")), "document": value(2),
        "_f": F.regexp_extract("place", DOCUMENT_PLACE, 3)})


def tree_files(spark, path: str) -> DataFrame:
    """(folder, document, file, modified) of every file of a tree, contents unread."""
    listed = list_files(spark, path)
    if listed is not None:
        return _named(listed).select("folder", "document", "file", "modified")
    return spark.read.format("binaryFile").load(path).select(
        F.coalesce(F.col("folder").cast("string"), F.lit("")).alias("folder"),
        F.col("document").cast("string").alias("document"), F.col("path").alias("file"),
        F.col("modificationTime").alias("modified"))


def read_tree(spark, path: str) -> DataFrame:
    """(folder, document, content, n_files) of a written tree (for checks: documents are
    read whole)."""
    listed = list_files(spark, path)
    if listed is not None:
        raw = read_files(_named(listed), "folder", "document", "_f")
    else:
        raw = spark.read.text(path, wholetext=True).select(F.coalesce(F.col("folder").cast(
            "string"), F.lit("")).alias("folder"), F.col("document").cast("string").alias(
            "document"), "value", F.col("_metadata.file_name").alias("_f"))
    return raw.groupBy("folder", "document").agg(
        F.expr("listagg(value, '') WITHIN GROUP (ORDER BY _f)").alias("content"),
        F.count(F.lit(1)).cast("int").alias("n_files"))
