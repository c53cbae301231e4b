"""Rendering linked documents as batch jobs (O-82..O-85, O-94, O-95).

A document is produced as ordered *blocks* ``(…, seq, block)``: a header
block and one block per verse (with its at most n links) or per listed
chapter. ``assemble`` joins the blocks of bounded documents into one string;
the document sink writes blocks in order without ever building a whole
document in one row, so a huge chapter streams through its writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.text import safe_name, wiki_link

NL = "\n"

# Fixed template values of the two chapter styles, the book and corpus indexes.
VAULT_LINKS_HEAD = "**Cross-References:**"
PATCH_LINKS_HEAD = "**Cross-references:**"
RULE = "---"
CORPUS_TITLE = "Corpus"
CORPUS_SUBTITLE = "*Linked units with their top references*"
CORPUS_FOOTER = "*Generated from the corpus tables*"


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _link_lines(links: str, style: str):
    """Lines of the nested link list (array<struct<book, chapter, verse, votes>>)."""
    if style == "vault":
        fmt = lambda l: F.concat(F.lit("- "), wiki_link(l["book"], l["chapter"], l["verse"]),
                                 F.lit(" *(votes: "), _s(l["votes"]), F.lit(")*"))
    else:
        fmt = lambda l: F.concat(F.lit("- "),
                                 wiki_link(l["book"], l["chapter"], l["verse"], drop_colon=False),
                                 F.lit(" (votes: "), _s(l["votes"]), F.lit(")"))
    return F.transform(F.col(links), fmt)


def verse_blocks(units: DataFrame, links: DataFrame | None = None, style: str = "vault",
                 key: str = "verse_id") -> DataFrame:
    """One block per verse: heading, quote, optional link list, rule.

    ``links`` is (key, links array<struct<book, chapter, verse, votes>>) in rank
    order, e.g. from ``links.links_by_key`` over the top-n links.
    """
    u = units
    if links is not None:
        u = u.join(links, key, "left")
    else:
        u = u.withColumn("links", F.lit(None).cast(
            "array<struct<book:string,chapter:int,verse:int,votes:int>>"))
    has = F.coalesce(F.size("links"), F.lit(0)) > 0
    lines = _link_lines("links", style)
    if style == "vault":
        head = VAULT_LINKS_HEAD
        # Each block ends with a newline; blocks are concatenated with ''.
        link_part = F.when(has, F.concat(F.lit(head + NL), F.array_join(lines, NL), F.lit(NL + NL))) \
            .otherwise(F.lit(""))
        block = F.concat(F.lit("## Verse "), _s("verse"), F.lit(NL + NL + "> "), F.col("text"),
                         F.lit(NL + NL), link_part, F.lit(RULE + NL + NL))
    elif style == "patch":
        head = PATCH_LINKS_HEAD
        # Lines joined by '\n' over the whole document: a block is its lines
        # joined by '\n', and blocks are joined by '\n'.
        link_part = F.when(has, F.concat(F.lit(head + NL), F.array_join(lines, NL), F.lit(NL + NL))) \
            .otherwise(F.lit(""))
        block = F.concat(F.lit("## Verse "), _s("verse"), F.lit(NL + NL + "> "), F.col("text"),
                         F.lit(NL + NL), link_part, F.lit(RULE + NL))
    else:
        raise ValueError(style)
    return u.select("book_name", "chapter", F.col("verse").cast("long").alias("seq"),
                    block.alias("block"))


def chapter_headers(units: DataFrame, style: str = "vault") -> DataFrame:
    """Header block per chapter (seq 0)."""
    if style == "vault":
        hdr = units.groupBy("book_name", "chapter").agg(
            F.first("testament").alias("_t"), F.first("book_number").alias("_n"))
        block = F.concat(F.lit("# "), F.col("book_name"), F.lit(" "), _s("chapter"),
                         F.lit(NL + NL + "*"), F.col("_t"), F.lit(" Testament, Book "), _s("_n"),
                         F.lit("*" + NL + NL + RULE + NL + NL))
    else:
        hdr = units.groupBy("book_name", "chapter").agg(F.count(F.lit(1)).alias("_c"))
        block = F.concat(F.lit("# "), F.col("book_name"), F.lit(" Chapter "), _s("chapter"),
                         F.lit(NL + NL + "**"), _s("_c"), F.lit(" verses**" + NL + NL + RULE + NL))
    return hdr.select("book_name", "chapter", F.lit(0).cast("long").alias("seq"),
                      block.alias("block"))


def render_chapters(units: DataFrame, links: DataFrame | None = None,
                    style: str = "vault") -> DataFrame:
    """O-82 (``'vault'``) / O-83 (``'patch'``): blocks of every chapter document."""
    return chapter_headers(units, style).unionByName(verse_blocks(units, links, style))


def assemble(blocks: DataFrame, keys=("book_name", "chapter"), style: str = "vault") -> DataFrame:
    """Join the blocks of each document in ``seq`` order (bounded documents only).

    Vault and index blocks end with their own newline and are concatenated;
    patch blocks are joined by '\\n' (the reference joins all lines by '\\n')."""
    sep = "" if style in ("vault", "index") else "\\n"
    doc = F.expr(f"listagg(block, '{sep}') WITHIN GROUP (ORDER BY seq)")
    return blocks.groupBy(*keys).agg(doc.alias("content"))


def book_index(units: DataFrame) -> DataFrame:
    """O-84: per book a header block and one link line per chapter, in chapter order."""
    ch = units.select("book_name", "testament", "book_number", "chapter").distinct()
    head = ch.groupBy("book_name").agg(F.first("testament").alias("_t"),
                                       F.first("book_number").alias("_n"),
                                       F.count(F.lit(1)).alias("_c"))
    head_block = F.concat(F.lit("# "), F.col("book_name"), F.lit(NL + NL + "**Testament:** "),
                          F.col("_t"), F.lit(NL + "**Book Number:** "), _s("_n"),
                          F.lit(NL + "**Chapters:** "), _s("_c"),
                          F.lit(NL + NL + "## Chapters" + NL + NL))
    line = F.concat(F.lit("- [["), safe_name("book_name"), F.lit("/Chapter_"), _s("chapter"),
                    F.lit("|Chapter "), _s("chapter"), F.lit("]]" + NL))
    return (head.select("book_name", F.lit(0).cast("long").alias("seq"), head_block.alias("block"))
            .unionByName(ch.select("book_name", F.col("chapter").cast("long").alias("seq"),
                                   line.alias("block"))))


def corpus_index(books: DataFrame, n_units: DataFrame, n_links: DataFrame,
                 title: str = CORPUS_TITLE, subtitle: str = CORPUS_SUBTITLE,
                 footer: str = CORPUS_FOOTER) -> DataFrame:
    """O-85: the corpus index as ordered blocks (one line per book).

    ``n_units`` / ``n_links`` are one-row counts (column ``n``). (section, seq)
    orders the Old section, then the New section, then the statistics.
    """
    entry = F.concat(_s("book_number"), F.lit(". [["), safe_name("book_name"), F.lit("/README|"),
                     F.col("book_name"), F.lit("]]" + NL))
    old = books.filter(F.col("testament") == "Old").select(
        F.lit(1).alias("section"), F.col("book_number").cast("long").alias("seq"), entry.alias("block"))
    new = books.filter(F.col("testament") == "New").select(
        F.lit(3).alias("section"), F.col("book_number").cast("long").alias("seq"), entry.alias("block"))
    spark = books.sparkSession
    fixed = spark.createDataFrame([
        (0, 0, f"# {title}{NL}{NL}{subtitle}{NL}{NL}{RULE}{NL}{NL}## Old Testament{NL}{NL}"),
        (2, 0, f"{NL}## New Testament{NL}{NL}")], "section int, seq long, block string")
    stats = (books.agg(F.count(F.lit(1)).alias("_b"))
             .withColumn("_u", n_units.select("n").scalar())
             .withColumn("_l", n_links.select("n").scalar())
             .select(F.lit(4).alias("section"), F.lit(0).cast("long").alias("seq"), F.concat(
                 F.lit(f"{NL}{RULE}{NL}{NL}## Statistics{NL}{NL}- **Total Books:** "), _s("_b"),
                 F.lit(f"{NL}- **Total Verses:** "), F.format_number("_u", 0),
                 F.lit(f"{NL}- **Cross-References:** "), F.format_number("_l", 0),
                 F.lit(f"{NL}{NL}{RULE}{NL}{NL}{footer}{NL}")).alias("block")))
    return fixed.unionByName(old).unionByName(new).unionByName(stats)


def count_headings(blocks: DataFrame, keys=("book_name", "chapter")) -> DataFrame:
    """O-94: verse headings per rendered document (its verse count)."""
    return blocks.groupBy(*keys).agg(
        F.sum(F.regexp_count("block", F.lit("## Verse "))).cast("long").alias("n_headings"))


def render_report(units: DataFrame) -> DataFrame:
    """O-95: chapters and verses written per book, plus a total row (book NULL)."""
    return units.rollup("book_name").agg(
        F.countDistinct("book_name", "chapter").cast("long").alias("n_chapters"),
        F.count(F.lit(1)).alias("n_verses"))
