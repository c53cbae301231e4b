"""Parsing running text into units (O-20..O-29, O-93) as one set-oriented plan.

Input: one row per book ``(book, text[, expected])``. The regexes run inside
the JVM (``regexp_extract_all``); chapter boundaries are a lag + running sum
over the match position, equal to the reference's sequential loop. A huge book is cut into
chunks at places no match crosses and parsed by many tasks (``chunk_chars``).

Regex notes (D14): Java needs ``(?d)`` so that only '\\n' ends a line, as in
Python; ``(?U)`` makes ``\\s`` and case folding Unicode-aware.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.functions.text import squash_ws, ustrip
from corpuslink.session import written

# Fixed patterns: they must select exactly what the reference's patterns select.
# v1 ('loose'): a number glued to a capital, up to the next such number or the end.
LOOSE_PATTERN = r"(?ds)(\d+)([A-Z].*?)(?=\d+[A-Z]|$)"
# v2 ('line'): a number at a line start followed by a capital or a quote; with
# MULTILINE the lazy text stops at the first line end (D8).
LINE_PATTERN = r"""(?dms)(?:^|\n)(\d+)([A-Z"'].*?)(?=(?:^|\n)\d+[A-Z"']|$)"""

RESET2_MAX_NUM, RESET2_MIN_PREV = 2, 10     # v1: num <= 2 after a number > 10
RESET1_NUM, RESET1_MIN_PREV = 1, 3          # v2: num == 1 after a kept number > 3
MIN_TEXT_LEN = 3                            # v2 drops shorter texts first


def strip_title(df: DataFrame, text: str = "text", book: str = "book",
                policy: str = "start") -> DataFrame:
    """O-20 / O-21: remove the book name (case-insensitive) from the very start
    (``'start'``), or from the start of every line plus the whitespace after it
    and then strip the whole text (``'lines'``)."""
    if policy == "start":
        pat = F.concat(F.lit(r"(?iU)^\Q"), F.col(book), F.lit(r"\E\s*"))
        return df.withColumn(text, F.regexp_replace(F.col(text), pat, F.lit("")))
    if policy == "lines":
        pat = F.concat(F.lit(r"(?dimU)^\Q"), F.col(book), F.lit(r"\E\s*\n*"))
        return df.withColumn(text, ustrip(F.regexp_replace(F.col(text), pat, F.lit(""))))
    raise ValueError(policy)


def split_units(df: DataFrame, text: str = "text", policy: str = "loose") -> DataFrame:
    """O-22 / O-23 / O-24: one row per match ``(…, pos, num, raw)``.

    ``'line_then_loose'`` uses the line pattern and falls back to the loose one
    for books where it finds nothing; books with no match yield no rows. Each pattern
    walks a text once; number and text are cut from its whole matches.
    """
    keep = [c for c in df.columns if c != text]
    found = lambda pattern: F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    if policy == "loose":
        rows = df.select(*keep, found(LOOSE_PATTERN).alias("_all"))
    elif policy == "line":
        rows = df.select(*keep, found(LINE_PATTERN).alias("_all"))
    elif policy == "line_then_loose":
        lines = df.select(*keep, text, found(LINE_PATTERN).alias("_lines"))
        rows = lines.select(*keep, F.when(F.size("_lines") == 0, found(LOOSE_PATTERN))
                            .otherwise(F.col("_lines")).alias("_all"))
    else:
        raise ValueError(policy)
    return (rows.select(*keep, F.posexplode("_all").alias("pos", "_m"))
            .select(*keep, "pos", F.regexp_extract("_m", r"^\n?(\d+)", 1).try_cast("long")
                    .alias("num"), F.regexp_replace("_m", r"^\n?\d+", "").alias("raw")))


def _resets(num, prev, policy: str):
    """1 where ``num`` after ``prev`` opens a chapter, else 0 (a number beyond 64 bits: 0)."""
    if policy == "reset2":
        flag = (num <= RESET2_MAX_NUM) & (prev > RESET2_MIN_PREV)
    elif policy == "reset1":
        flag = (num == RESET1_NUM) & (prev > RESET1_MIN_PREV)
    else:
        raise ValueError(policy)
    return F.coalesce(flag.cast("int"), F.lit(0))


def _kept(m: DataFrame, policy: str) -> DataFrame:
    """What counts for chapter boundaries: all matches, or (v2) those of three characters."""
    return m.filter(F.length("text") >= MIN_TEXT_LEN) if policy == "reset1" else m


def _valid(numbered: DataFrame, policy: str, expected: str | None) -> DataFrame:
    """(…, chapter, verse, text) of the rows that are no longer needed for boundaries."""
    if policy == "reset2":
        out = numbered.filter(F.col("text") != "")
    else:
        out = numbered.filter(F.col("num") > 0)
        if expected:
            out = out.withColumn("chapter", F.least("chapter", expected))
    return out.withColumn("chapter", F.col("chapter").cast("int")) \
        .withColumn("verse", F.col("num").cast("int")).drop("raw", "num")


def segment(matches: DataFrame, book: str = "book", policy: str = "reset2",
            expected: str | None = None) -> DataFrame:
    """O-25..O-28: clean texts, validity filters and chapter boundaries.

    ``'reset2'`` (v1): every match updates the previous number; a new chapter
    starts when num <= 2 after a number > 10; empty texts are dropped after.
    ``'reset1'`` (v2): texts shorter than 3 characters are dropped first; a new
    chapter starts when num == 1 after a kept number > 3, capped at
    ``expected``; numbers <= 0 are dropped after.
    Result: (…, chapter, verse, text).
    """
    m = _kept(matches.withColumn("text", squash_ws("raw")), policy)
    w = Window.partitionBy(book).orderBy("pos")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("_f", _resets(F.col("num"), F.lag("num", 1, 0).over(w), policy))
    return _valid(m.withColumn("chapter", 1 + F.sum("_f").over(running)).drop("_f"), policy,
                  expected)


def segment_chunks(matches: DataFrame, book: str = "book", policy: str = "reset2",
                   expected: str | None = None) -> DataFrame:
    """``segment`` for matches of books cut into chunks: (…, chunk, pos, num, raw).

    A chunk counts its own resets after its first number; its summary (resets, first and last
    number, matches) is associative, so a prefix scan over a book's chunks gives what comes in:
    the number before its first and the resets so far. No window spans more than a chunk's
    matches or a book's chunks. ``pos`` becomes the place in the book. The matches should be
    written: they are read three times.
    """
    every = matches.withColumn("text", squash_ws("raw"))
    here = Window.partitionBy(book, "chunk").orderBy("pos")
    before = F.lag(F.struct("num"), 1).over(here)
    rows = _kept(every, policy).withColumn("_f", F.when(before.isNull(), F.lit(0)).otherwise(
        _resets(F.col("num"), before["num"], policy)))
    rows = rows.withColumn("_f", F.sum("_f").over(
        here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = rows.groupBy(book, "chunk").agg(
        F.max("_f").alias("_resets"), F.min(F.struct("pos", "num"))["num"].alias("_first"),
        F.max(F.struct("pos", "num"))["num"].alias("_last"))
    over = Window.partitionBy(book).orderBy("chunk")
    last = F.lag(F.struct("_last"), 1).over(over)
    opens = _resets(F.col("_first"), F.when(last.isNull(), F.lit(0)).otherwise(last["_last"]),
                    policy)
    so_far = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_opens", opens).select(
        F.col(book).alias("_b"), F.col("chunk").alias("_c"),
        (F.sum(F.col("_resets") + F.col("_opens")).over(so_far) - F.col("_resets")).alias("_in"))
    sizes = every.groupBy(book, "chunk").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(F.col(book).alias("_b2"), F.col("chunk").alias("_c2"),
                         (F.sum("_n").over(so_far) - F.col("_n")).alias("_at"))
    joined = rows.join(ends, F.col(book).eqNullSafe(F.col("_b")) & (F.col("chunk") == F.col("_c"))) \
        .join(sizes, F.col(book).eqNullSafe(F.col("_b2")) & (F.col("chunk") == F.col("_c2")))
    numbered = joined.withColumns({"chapter": 1 + F.col("_in") + F.col("_f"),
                                   "pos": (F.col("pos") + F.col("_at")).cast("long")})
    return _valid(numbered.drop("_f", "_b", "_c", "_b2", "_c2", "_in", "_at", "chunk"), policy,
                  expected)


# Where a text may be cut so that every match lies in one piece: before a number glued to a
# capital (the loose pattern's texts end there), or after a line feed before a letter, digit
# or quote (no title, line or white space that the line pattern's steps touch reaches across).
CUT_BEFORE = {"marker": re.compile(r"(?<![0-9])[0-9]+[A-Z]"),
              "line": re.compile(r"""(?<=\n)[0-9A-Za-z"']""")}


def cut_places(text: str, at: str, chunk_chars: int) -> list[int]:
    """Starts of the pieces: 0, then the first allowed place ``chunk_chars`` or more on."""
    places, pattern = [0], CUT_BEFORE[at]
    while found := pattern.search(text, places[-1] + chunk_chars):
        places.append(found.start())
    return places


def chunk_texts(df: DataFrame, text: str, at: str, chunk_chars: int, book: str = "book"
                ) -> DataFrame:
    """``df`` with each text as rows (…, chunk, text), spread over the tasks."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name != text],
                           T.StructField("chunk", T.LongType()),
                           T.StructField(text, T.StringType())])
    names = schema.fieldNames()

    def per_task(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                value = row.column(text)[0].as_py()
                places = [] if value is None else cut_places(value, at, chunk_chars)
                for c in range(0, len(places), 64):          # pieces of 64 chunks at a time
                    some, ends = places[c:c + 64], [*places[1:], len(value)][c:c + 64]
                    columns = {n: pa.chunked_array([row.column(n)] * len(some)).combine_chunks()
                               for n in names[:-2]}
                    columns["chunk"] = pa.array(range(c, c + len(some)), pa.int64())
                    columns[text] = pa.array([value[a:b] for a, b in zip(some, ends)], pa.string())
                    yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return df.mapInArrow(per_task, schema).repartition(book, "chunk")


def parse_book_text(books: DataFrame, policy: str = "v1", book: str = "book",
                    text: str = "text", expected: str | None = None,
                    chunk_chars: int | None = None) -> DataFrame:
    """The reference's two parsers end to end (title strip, split, segment).

    With ``chunk_chars`` the texts are cut into pieces of about that size, so one huge book is
    parsed by many tasks, with the same result; one task only looks for the cuts.
    """
    if policy not in ("v1", "v2"):
        raise ValueError(policy)
    if chunk_chars is None:
        if policy == "v1":
            m = split_units(strip_title(books, text, book, "start"), text, "loose")
            return segment(m, book, "reset2")
        m = split_units(strip_title(books, text, book, "lines"), text, "line_then_loose")
        return segment(m, book, "reset1", expected)
    if policy == "v1":
        cut = chunk_texts(strip_title(books, text, book, "start"), text, "marker", chunk_chars, book)
        return segment_chunks(written(split_units(cut, text, "loose"), "matches"), book, "reset2")
    cut = chunk_texts(books, text, "line", chunk_chars, book)
    lines = written(split_units(strip_title(cut, text, book, "lines"), text, "line"), "matches")
    found = lines.select(F.col(book).alias("_found")).distinct()
    rest = books.join(found, F.col(book).eqNullSafe(F.col("_found")), "left_anti")
    cut = chunk_texts(strip_title(rest, text, book, "lines"), text, "marker", chunk_chars, book)
    loose = split_units(cut, text, "loose")
    return segment_chunks(written(lines.unionByName(loose), "matches"), book, "reset1", expected)


def load_report(units: DataFrame, books: DataFrame, book: str = "book",
                expected: str = "expected") -> DataFrame:
    """O-29: per book - units inserted, distinct chapters, expected chapters."""
    st = units.groupBy(book).agg(F.count(F.lit(1)).alias("n_units"),
                                 F.countDistinct("chapter").cast("long").alias("n_chapters"))
    return books.select(book, expected).join(st, book, "left").na.fill(0, ["n_units",
                                                                            "n_chapters"])


def assemble_pages(pages: DataFrame, book: str = "book", page: str = "page",
                   text: str = "text", book_number: str | None = None) -> DataFrame:
    """O-93: a book's pages joined in page order, a newline after each page; the
    file number is the book number zero-padded to two digits.

    Groups are books (bounded by their page count)."""
    out = pages.groupBy(book).agg(F.expr(
        f"listagg(concat({text}, char(10)), '') WITHIN GROUP (ORDER BY {page})").alias("text"))
    if book_number:
        num = pages.select(book, book_number).distinct()
        s = F.col(book_number).cast("string")
        # zfill(2): pad short numbers, never cut long ones (lpad would cut).
        out = out.join(num, book).withColumn(
            "file_no", F.when(F.length(s) >= 2, s).otherwise(F.lpad(s, 2, "0")))
    return out
