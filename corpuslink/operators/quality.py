"""Completeness audit and targeted repair (O-55..O-60).

``books`` carries one row per expected group with ``expected`` chapters;
``units`` carries (key, chapter[, verse]). Grids are generated per group with
``sequence`` and compared by anti joins, so interior holes are found too (the
MAX-based check of the reference only sees missing last chapters, D9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.operators.upsert import upsert


GRID_BLOCK = 10_000     # numbers of one group generated at a time


def number_grid(df: DataFrame, top: str, out: str) -> DataFrame:
    """One row per number 1..top of each row (none when top < 1), in bounded blocks."""
    n = F.col(top)
    at = F.when(n >= 1, F.sequence(F.lit(0), F.floor((n - 1) / GRID_BLOCK)))
    rows = df.withColumn("_at", F.explode(at))
    low = F.col("_at") * GRID_BLOCK + 1
    numbers = F.sequence(low, F.least(low + GRID_BLOCK - 1, n.cast("long")))
    return rows.withColumn(out, F.explode(numbers.cast(T.ArrayType(df.schema[top].dataType)))) \
        .drop("_at")


def missing_books(books: DataFrame, units: DataFrame, key: str = "key") -> DataFrame:
    """O-55: expected groups without any unit."""
    return books.join(units.select(key), key, "left_anti")


def chapter_stats(units: DataFrame, key: str = "key", chapter: str = "chapter") -> DataFrame:
    return units.groupBy(key).agg(F.max(chapter).alias("max_chapter"),
                                  F.countDistinct(chapter).cast("long").alias("n_chapters"),
                                  F.count(F.lit(1)).alias("n_units"))


def chapter_mismatch(books: DataFrame, units: DataFrame, key: str = "key",
                     chapter: str = "chapter", expected: str = "expected") -> DataFrame:
    """O-56: groups whose highest chapter differs from the expected count."""
    st = chapter_stats(units, key, chapter)
    return (st.join(books.select(key, expected), key)
            .filter(F.col("max_chapter") != F.col(expected))
            .select(key, "max_chapter", expected))


def empty_chapters_parity(units: DataFrame, key: str = "key",
                          chapter: str = "chapter") -> DataFrame:
    """O-57: the reference's HAVING count = 0 after an inner join: always empty (D9).
    Kept for parity only; not registered as a query."""
    return (units.groupBy(key, chapter).agg(F.count(F.lit(1)).alias("n_units"))
            .filter(F.col("n_units") == 0))


def chapter_gaps(books: DataFrame, units: DataFrame, key: str = "key",
                 chapter: str = "chapter", expected: str = "expected") -> DataFrame:
    """O-58: expected (group, chapter) pairs with no unit, for groups that exist.

    Groups without any unit are reported by ``missing_books`` instead.
    """
    present = books.join(units.select(key), key, "left_semi")
    grid = number_grid(present.select(key, expected), expected, chapter).select(key, chapter)
    return grid.join(units.select(key, chapter), [key, chapter], "left_anti")


def verse_gaps(units: DataFrame, group: Sequence[str], verse: str = "verse") -> DataFrame:
    """O-58: missing verse numbers between 1 and the highest verse of each group.

    The grid is generated per group and compared by an anti join, so a very
    large group is spread over the shuffle rather than scanned in one window.
    """
    group = list(group)
    top = units.groupBy(*group).agg(F.max(verse).alias("_max"))
    grid = number_grid(top, "_max", verse).select(*group, verse)
    return grid.join(units.select(*group, verse), group + [verse], "left_anti")


def audit(books: DataFrame, units: DataFrame, key: str = "key", chapter: str = "chapter",
          expected: str = "expected") -> tuple[DataFrame, DataFrame]:
    """O-59: per-group status ('ok' / 'missing' / 'n of m') and a one-row verdict.

    Complete iff no group is missing and no group's highest chapter differs.
    """
    st = chapter_stats(units, key, chapter)
    status = (books.select(key, expected).join(st, key, "left")
              .withColumn("status",
                          F.when(F.col("max_chapter").isNull(), F.lit("missing"))
                          .when(F.col("max_chapter") == F.col(expected), F.lit("ok"))
                          .otherwise(F.concat(F.col("max_chapter").cast("string"), F.lit(" of "),
                                              F.col(expected).cast("string")))))
    verdict = status.agg(
        F.count_if(F.col("status") == "missing").alias("n_missing"),
        F.count_if(~F.col("status").isin("ok", "missing")).alias("n_mismatch"),
        F.coalesce(F.bool_and(F.col("status") == "ok"), F.lit(True)).alias("complete"))
    return status.select(key, "status"), verdict


def backfill(target: DataFrame, payloads: DataFrame, wanted: DataFrame,
             keys: Sequence[str], order: Sequence[str], id_col: str | None = None) -> DataFrame:
    """O-60: load only the wanted (group, chapter) pairs from the payloads and
    upsert them (last wins, ids kept). ``wanted`` is typically ``chapter_gaps``."""
    wkeys = list(wanted.columns)
    picked = payloads.join(wanted, wkeys, "left_semi")
    return upsert(target, picked, keys, order, id_col)
