"""O-04 / O-05: the book dimension and the verse export scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.query import units_view
from corpuslink.operators.upsert import assign_ids
from corpuslink.schema import BOOKS


def books_df(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """O-04: a literal book table from (book_number, name, testament,
    expected_chapters) rows; book_id is the 1-based position in ``rows``.

    The dimension is small by nature; joins to it are left to AQE, which
    broadcasts it from its measured size."""
    data = [(i, int(n), str(name), str(t), int(c) if c is not None else None)
            for i, (n, name, t, c) in enumerate(rows, start=1)]
    return spark.createDataFrame(data, BOOKS)


def books_from(rows: DataFrame, order: Sequence[str] = ("book_number",)) -> DataFrame:
    """O-04 from a table: (book_number, book_name, testament, expected_chapters) rows with
    book_id, their 1-based position in ``order``; nothing passes the driver."""
    return assign_ids(rows, order, "book_id").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BOOKS.fields])


def load_verses(verses: DataFrame, books: DataFrame, sort: bool = False) -> DataFrame:
    """O-05: verses joined to books with their reference; ordered only when
    ``sort`` (at a sink)."""
    v = units_view(verses, books)
    return v.orderBy("book_number", "chapter", "verse") if sort else v
