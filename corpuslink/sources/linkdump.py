"""O-03: link statements in SQL text dumps, parsed with one regex per line.

Only lines containing ``VALUES`` (case-sensitive) are statements; a statement
that does not match (negative votes, an apostrophe in a name, …) is kept with
``matched = false`` so that it can be counted and sampled (D7, O-34).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.query import top_n_per_key

# Fixed value: the statement pattern (8 groups: from book, chapter, verse; to
# book, chapter, first verse, last verse; votes). Names cannot contain "'".
LINK_PATTERN = r"VALUES\s*\('([^']+)',\s*(\d+),\s*(\d+),\s*'([^']+)',\s*(\d+),\s*(\d+),\s*(\d+),\s*(\d+)\)"  # noqa: E501
MARKER = "VALUES"
FIELDS = ("from_book", "from_chapter", "from_verse", "to_book", "to_chapter",
          "to_verse_start", "to_verse_end", "votes")


_SEP = "\u0001"


def parse_link_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Statement lines -> (…, matched, 8 fields). Non-statement lines are dropped.

    One ``regexp_replace`` rewrites the first match into the eight groups
    separated by U+0001 and ``split`` cuts them apart - a single regex pass
    instead of one ``regexp_extract`` per field. ``matched`` is the reference's
    ``re.search`` succeeding.
    """
    st = lines.filter(F.col(text).contains(MARKER))
    groups = _SEP.join(f"${i}" for i in range(1, len(FIELDS) + 1))
    parts = F.split(F.regexp_replace(F.col(text), r"(?s)^.*?" + LINK_PATTERN + r".*$", groups),
                    _SEP)
    # A line that does not match stays one part (it holds no U+0001 that counts).
    out = st.withColumn("_p", parts).withColumn("matched", F.size("_p") == len(FIELDS))
    cols = []
    for i, name in enumerate(FIELDS):
        raw = F.get("_p", F.lit(i))
        if name in ("from_book", "to_book"):
            cols.append(F.when(F.col("matched"), raw).alias(name))
        else:
            # try_cast keeps ANSI mode from raising on an overlong number.
            cols.append(F.when(F.col("matched"), raw.try_cast("long")).alias(name))
    # Emit the fields through a generator: Catalyst cannot push filters on
    # generator output below it, so joins on these keys (and the not-null
    # filters they imply) never re-inline the regex work into predicates.
    fields = F.struct(F.col("matched"), *cols)
    return out.select(*st.columns, F.inline(F.array(fields)))


def read_link_dump(spark: SparkSession, path: str) -> DataFrame:
    """Read ``cross_references_*.sql``-style files as (file, line_no, value, …).

    ``spark.read.text`` has no line numbers; (part, block start, row id within the split)
    is a total order that follows the file. A dump may also be a folder ``file=NAME`` of
    part files, whose names give their order. Never ``wholetext``.
    """
    raw = spark.read.text(path)
    return parse_link_lines(numbered_lines(raw))


def numbered_lines(raw: DataFrame) -> DataFrame:
    """(file, line_no, value) of dump files read as text, by batch or stream."""
    name = F.col("file") if "file" in raw.columns else F.col("_metadata.file_name")
    raw = raw.select("value", name.alias("file"), F.col("_metadata.file_name").alias("_part"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_row"))
    return raw.select("file", F.struct("_part", "_block", "_row").alias("line_no"), "value")


def write_link_dump(lines: DataFrame, path: str, order, value: Column | None = None) -> None:
    """Land statement lines (file, value) as folders ``file=NAME`` of gzipped text files that
    follow ``order``. A statement given as an expression, ``value``, is formatted behind the
    shuffle, which then carries its fields only."""
    (lines.repartitionByRange("file", *order).sortWithinPartitions("file", *order)
     .select("file", "value" if value is None else value.alias("value")).write.mode("overwrite")
     .option("compression", "gzip").partitionBy("file").text(path))


def reject_sample(parsed: DataFrame, order, n: int = 3, text: str = "value") -> DataFrame:
    """O-34: statements that failed to parse among the first ``n`` of their file."""
    first = top_n_per_key(parsed, ["file"], order, n, "_r")
    return first.filter(~F.col("matched")).select("file", text)
