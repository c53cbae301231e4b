"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a stretch of ``block_words`` words; blocks start every ``stride`` words, so a
notice of up to ``block_words - stride`` words lies whole in one. A block matches a
template when it holds at least ``threshold`` of the template's distinct words. The join
is exact and filtered as set joins are: template words are ordered by the documents that
hold them (rarest first, counted over all documents); of a template of t words that needs
a of them, one of its first t - a + 1 must be in the block (prefix filter), the block
must have a words (length filter), and from the shared word on enough words must be left
on both sides (positional filter). What passes is counted word by word.

Templates are few and given as a parameter; their index is broadcast up to
``MAX_INDEX_ROWS`` rows and joined by a shuffle beyond.

Words: lower-cased runs of ASCII letters and digits and of non-ASCII characters. A null
or empty text has no word, no block and no label. Repeated rows get the same answer each.
Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases (words between single spaces) and their labels: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: License notices and the labels the join adds: fixed values, public wording.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification "
           "are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with "
           "or without fee is hereby granted",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy "
                      "of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
BLOCK_WORDS = 64
STRIDE = 32
MAX_INDEX_ROWS = 100_000


def spaced(text: Column) -> Column:
    """The words in lower case, two spaces before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")),
                            NO_WORD, "  ")


def words_in(part: Column) -> Column:
    """How many words stand before or behind a phrase cut out of a spaced text with one
    space at each of its ends."""
    return F.floor((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2)


def base_columns(words: Column) -> dict[str, Column]:
    """Places, first and last start, and labels of the fixed phrases in a spaced text."""
    places, firsts, lasts, labels = [], [], [], []
    n = words_in(words) - 1
    for phrase, label in PHRASES.items():
        wanted = " " + phrase.replace(" ", "  ") + " "
        held = F.contains(words, F.lit(wanted))
        places.append(F.when(held, F.size(F.split(words, wanted)) - 1).otherwise(0))
        firsts.append(F.when(held, words_in(F.substring_index(words, wanted, 1))))
        lasts.append(F.when(held, n - words_in(F.substring_index(words, wanted, -1))
                            - len(phrase.split())))
        labels.append(F.when(held, F.lit(label)))
    return {"n_base": sum(places[1:], places[0]).cast("long"),
            "first_word": F.least(*firsts), "last_word": F.greatest(*lasts),
            "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))}


def word_array(words: Column) -> Column:
    return F.array_remove(F.split(words, " +"), "")


def template_index(docs: DataFrame, templates: dict[str, str], threshold: float,
                   text_col: str) -> DataFrame:
    """(template, word, place, prefix, needed, size, words): each template's words ordered
    by how many documents hold them. One row per word of a template."""
    spark = docs.sparkSession
    rows = [(name, w, len(set(text.split())), sorted(set(text.split())))
            for name, text in templates.items() for w in sorted(set(text.split()))]
    given = spark.createDataFrame(rows, "template string, word string, size int, "
                                        "words array<string>")
    vocabulary = sorted({r[1] for r in rows})
    held = docs.select(F.explode(F.array_intersect(word_array(spaced(F.col(text_col))), F.array(
        *[F.lit(w) for w in vocabulary]))).alias("word"))
    counts = held.groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    from pyspark.sql.window import Window
    by_rarity = Window.partitionBy("template").orderBy("rarity", "word")
    needed = F.ceil(F.lit(threshold) * F.col("size") - F.lit(1e-9)).cast("int")
    return given.join(counts, "word", "left").withColumn(
        "rarity", F.coalesce("docs", F.lit(0))).withColumn("needed", needed).withColumn(
        "place", F.row_number().over(by_rarity) - 1).withColumn(
        "prefix", F.col("place") <= F.col("size") - F.col("needed"))


def blocks_of(docs: DataFrame, text_col: str, keep: list[str], some: list[str],
              block_words: int, stride: int) -> DataFrame:
    """(keep, block, tokens) of the stretches that hold a word of ``some``. A text without
    any of these words is not cut, and blocks without one are not exploded. (Conditions
    stand in the columns: as filters they would be pushed below and computed twice.)"""
    held = F.lit(False)
    for w in some:
        held = held | F.contains(F.col("_words"), F.lit(f" {w} "))
    cut = docs.select(*keep, spaced(F.col(text_col)).alias("_words")).select(
        *keep, F.when(held, word_array(F.col("_words"))).alias("_list"))
    wanted = F.array(*[F.lit(w) for w in some])
    starts = F.sequence(F.lit(0), F.greatest(F.size("_list") - 1, F.lit(0)), F.lit(stride))
    blocks = F.filter(F.transform(starts, lambda i: F.struct(
        i.cast("long").alias("block"), F.array_distinct(F.slice("_list", i + 1, F.lit(
            block_words))).alias("tokens"))), lambda b: F.arrays_overlap(b["tokens"], wanted))
    return cut.select(*keep, F.explode_outer(F.when(F.col("_list").isNotNull(), blocks)).alias(
        "_b")).where(F.col("_b").isNotNull()).select(*keep, "_b.block", "_b.tokens")


def find_notices(docs: DataFrame, *, keep: list[str], text_col: str = "text",
                 templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                 block_words: int = BLOCK_WORDS, stride: int = STRIDE) -> DataFrame:
    """Every (keep, block, template, containment) that meets the threshold; ``block`` is
    the number of the block's first word."""
    from corpuslink.llm.scratch import written
    index = written(template_index(docs, templates, threshold, text_col), "templates")
    rarest = sorted({r[0] for r in index.where("prefix").select("word").collect()})
    blocks = blocks_of(docs, text_col, keep, rarest, block_words, stride)
    small = index.count() <= MAX_INDEX_ROWS
    hint = F.broadcast if small else (lambda df: df)
    # a block's template words, in the order of their rarity
    order = index.groupBy("word").agg(F.max("rarity").alias("rarity"))
    ranks = order.select(F.array_sort(F.collect_list(F.struct("rarity", "word"))).alias("all"))
    ranked = ranks.select(F.transform("all", lambda s: s["word"]).alias("r")).scalar()
    ordered = blocks.withColumn("_known", F.array_intersect(ranked, F.col("tokens")))
    seen = ordered.select("*", F.posexplode("_known").alias("_place", "word"))
    first = hint(index.where("prefix").select("template", "word", "place", "size", "needed",
                                              "words"))
    near = seen.join(first, "word").where(
        (F.size("tokens") >= F.col("needed"))
        & (F.least(F.col("size") - F.col("place"), F.size("_known") - F.col("_place"))
           + F.least(F.col("place"), F.col("_place")) >= F.col("needed")))
    shared = F.size(F.array_intersect("tokens", "words"))
    return near.where(shared >= F.col("needed")).groupBy(*keep, "block", "template").agg(
        F.max(shared / F.col("size")).alias("containment"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options
         ) -> DataFrame:
    """Per row: id, n_words, the base columns, labels (base and found) and score (the
    best containment; 1 where a base phrase stands)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_hash"),
                       F.col(text_col).alias("text"))
    found = find_notices(rows, keep=["doc_id", "_hash"], **options).groupBy("doc_id", "_hash").agg(
        F.collect_set("template").alias("_found"), F.max("containment").alias("_best"))
    base = rows.withColumn("_words", spaced(F.col("text"))).select(
        "doc_id", "_hash", (words_in(F.col("_words")) - 1).alias("n_words"),
        *(c.alias(k) for k, c in base_columns(F.col("_words")).items()))
    every = F.array_sort(F.array_distinct(F.concat(
        "base", F.coalesce("_found", F.array().cast("array<string>")))))
    return base.join(found, base["doc_id"].eqNullSafe(found["doc_id"])
                     & (base["_hash"] == found["_hash"]), "left").select(
        base["doc_id"], "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
            F.coalesce("_best", F.lit(0.0))).alias("score"))


def _oracle() -> str:
    phrases = ", ".join(f"('{p}', {len(p.split())}, '{x}')" for p, x in PHRASES.items())
    templates = ", ".join(f"('{n}', string_split('{t}', ' '))" for n, t in TEMPLATES.items())
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p(phrase, n, label) AS (VALUES {phrases}),
t(template, words) AS (VALUES {templates}),
u AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d
      WHERE list_has_any(w, ['license', 'cc'])),
hits AS (
  SELECT doc_id, i, label FROM u JOIN p
    ON array_to_string(w[i + 1 : i + n], ' ') = phrase),
b AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         list_distinct(list(label)) AS labels FROM hits GROUP BY doc_id),
blocks AS (
  SELECT doc_id, list_distinct(w[s + 1 : s + {BLOCK_WORDS}]) AS k
  FROM (SELECT doc_id, w, unnest(range(0, len(w), {STRIDE})) AS s FROM d)),
m AS (
  SELECT doc_id, template,
         len(list_intersect(k, words)) / len(list_distinct(words)) AS share
  FROM blocks, t WHERE len(list_intersect(k, words)) >= {THRESHOLD} * len(list_distinct(words))
                       - 1e-9),
f AS (SELECT doc_id, list_distinct(list(template)) AS labels, max(share) AS best
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       first_word, last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         coalesce(b.labels, []) || coalesce(f.labels, []))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN f ON f.doc_id = d.doc_id
"""


ORACLE_SQL = _oracle()
