"""String expressions used by parsing and rendering (O-25, O-86..O-90)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` only removes ASCII space)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def squash_ws(c) -> Column:
    """O-25: runs of whitespace become one space, then strip."""
    return ustrip(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def reference(book, chapter, verse) -> Column:
    """O-86: human key ``"{book} {chapter}:{verse}"``."""
    return F.concat(_c(book), F.lit(" "), _c(chapter).cast("string"), F.lit(":"),
                    _c(verse).cast("string"))


def safe_name(c, drop_colon: bool = True) -> Column:
    """O-87: space and '/' become '_'; ':' is removed in the main renderer only."""
    if drop_colon:
        return F.translate(_c(c), " /:", "__")
    return F.translate(_c(c), " /", "__")


def wiki_link(book, chapter, verse, drop_colon: bool = True) -> Column:
    """O-88: ``[[Folder/Chapter_n#Verse v|Book n:v]]``."""
    return F.concat(F.lit("[["), safe_name(book, drop_colon), F.lit("/Chapter_"),
                    _c(chapter).cast("string"), F.lit("#Verse "), _c(verse).cast("string"),
                    F.lit("|"), reference(book, chapter, verse), F.lit("]]"))


def fmt_int(c) -> Column:
    """O-89: thousands separator, no decimals."""
    return F.format_number(_c(c), 0)


def fmt_decimal(c, places: int) -> Column:
    """O-89: fixed decimals. Exact binary halves round up here (see D10)."""
    return F.format_string(f"%.{places}f", _c(c).cast("double"))


def preview(c, n: int) -> Column:
    """O-90: first ``n`` characters followed by '...'."""
    return F.concat(F.substring(_c(c), 1, n), F.lit("..."))
