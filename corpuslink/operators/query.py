"""Views, lookups, filters, aggregates and ordered listings (O-35..O-49, O-54).

Orderings are only applied where they are the feature (a limited listing or a
sink); everything else is an unordered DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.functions.text import reference

UNIT_ORDER = ("book_number", "chapter", "verse")


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of every key under ``order`` (which must be total).

    ``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key sends at most ``n`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def units_view(verses: DataFrame, books: DataFrame) -> DataFrame:
    """O-35: verses joined to their book (the denormalised view), plus ``reference``.

    The book side is a dimension; AQE broadcasts it from its measured size.
    """
    b = books.select("book_id", "book_number", "book_name", "testament")
    return (verses.join(b, "book_id")
            .select("verse_id", "book_name", "testament", "book_number", "chapter", "verse",
                    "text", reference("book_name", "chapter", "verse").alias("reference")))


def lookup(units: DataFrame, book: str, chapter: int, verse: int) -> DataFrame:
    """O-37: point lookup by natural key (equalities reach the Parquet scan)."""
    return units.filter((F.col("book_name") == book) & (F.col("chapter") == chapter)
                        & (F.col("verse") == verse))


def chapter(units: DataFrame, book: str, chapter_no: int, n: int | None = None) -> DataFrame:
    """O-38: the verses of one chapter in verse order, optionally the first ``n``."""
    out = units.filter((F.col("book_name") == book) & (F.col("chapter") == chapter_no)) \
        .orderBy("verse")
    return out.limit(n) if n is not None else out


def _like_escape(needle: str) -> str:
    return needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def search_text(units: DataFrame, needle: str, n: int | None = None,
                order: Sequence[str] = UNIT_ORDER) -> DataFrame:
    """O-39: case-insensitive substring search (D15: Unicode folding): the first ``n`` in
    an explicit order (D3), or all, unordered (a sink orders them if it must)."""
    out = units.filter(F.col("text").ilike(f"%{_like_escape(needle)}%"))
    return out.orderBy(*order).limit(n) if n is not None else out


def chapters_of(units: DataFrame) -> DataFrame:
    """O-41: distinct chapters present in every book, all books in one pass."""
    return units.select("book_number", "book_name", "chapter").distinct()


def filter_units(df: DataFrame, testament: str | None = None,
                 books: Sequence[str] | None = None) -> DataFrame:
    """O-42: group equality and book membership; None, '' or [] mean no filter."""
    if testament:
        df = df.filter(F.col("testament") == testament)
    if books:
        df = df.filter(F.col("book_name").isin(list(books)))
    return df


def counts(**tables: DataFrame) -> DataFrame:
    """O-44: one row, one ``n_<name>`` column per table (global counts, partial aggs)."""
    items = list(tables.items())
    first_name, first = items[0]
    # One row: the first count, the others as scalar subqueries.
    return first.agg(F.count(F.lit(1)).alias(f"n_{first_name}")).select(
        "*", *[df.agg(F.count(F.lit(1))).scalar().alias(f"n_{name}") for name, df in items[1:]])


def distinct_counts(units: DataFrame) -> DataFrame:
    """O-45: distinct chapters per book."""
    return units.groupBy("book_number", "book_name").agg(
        F.countDistinct("chapter").cast("long").alias("n_chapters"))


def books_with_units(units: DataFrame) -> DataFrame:
    """O-45: number of distinct books that have at least one unit."""
    return units.agg(F.countDistinct("book_name").cast("long").alias("n_books"))


def by_group(units: DataFrame, col: str = "testament") -> DataFrame:
    """O-46: units per group."""
    return units.groupBy(col).agg(F.count(F.lit(1)).alias("n_units"))


def largest(units: DataFrame, col: str = "book_name") -> DataFrame:
    """O-47: the group with the most units; ties broken by name."""
    return (units.groupBy(col).agg(F.count(F.lit(1)).alias("n_units"))
            .orderBy(F.desc("n_units"), F.asc(col)).limit(1))


def max_chapter(units: DataFrame) -> DataFrame:
    """O-48: highest chapter per book, grouped with the book number for canonical order."""
    return units.groupBy("book_number", "book_name").agg(F.max("chapter").alias("max_chapter"))


def verses_per_chapter(units: DataFrame, min_count: int | None = None,
                       max_count: int | None = None) -> DataFrame:
    """O-49: units per chapter with an optional HAVING range."""
    out = units.groupBy("book_number", "book_name", "chapter").agg(
        F.count(F.lit(1)).alias("n_units"))
    if min_count is not None:
        out = out.filter(F.col("n_units") >= min_count)
    if max_count is not None:
        out = out.filter(F.col("n_units") <= max_count)
    return out
