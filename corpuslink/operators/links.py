"""Weighted link graph: import, views, top-k and nesting (O-30..O-34, O-36, O-40, O-50..O-52).

Edges are ``(from_id, to_id, votes)``; a unit table is ``(unit_id, book, chapter, verse)``
plus whatever canonical-order columns the caller keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.text import reference
from corpuslink.operators.query import top_n_per_key
from corpuslink.operators.upsert import first_per_key, with_default
from corpuslink.session import written


NOWHERE = 1 << 14


def link_order():
    """D3: votes desc, then target id - a total order within a source."""
    return (F.desc("votes"), F.asc("to_id"))


def dedupe_edges(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """O-32: one edge per (from_id, to_id); the first in arrival ``order`` keeps its votes.

    ``min_by`` pre-aggregates map-side, so repeated pairs never pile up in one task.
    """
    return first_per_key(raw.select("from_id", "to_id", "votes", *order),
                         ["from_id", "to_id"], order).select("from_id", "to_id", "votes")


def _ends(units: DataFrame, side: str) -> DataFrame:
    return units.select(F.col("unit_id").alias(f"{side}_id"),
                        F.col("book").alias(f"{side}_book"),
                        F.col("chapter").alias(f"{side}_chapter"),
                        F.col("verse").alias(f"{side}_verse"))


def links_view(edges: DataFrame, from_units: DataFrame, to_units: DataFrame) -> DataFrame:
    """O-36: readable link view - both ends resolved to (book, chapter, verse)."""
    return (edges.join(_ends(from_units, "from"), "from_id")
            .join(_ends(to_units, "to"), "to_id")
            .select("from_id", "to_id", "from_book", "from_chapter", "from_verse",
                    "to_book", "to_chapter", "to_verse", "votes"))


def top_links(view: DataFrame, book=None, chapter=None, verse=None, k: int = 5) -> DataFrame:
    """O-40: top-k links of one source unit by votes desc (tie on target).

    The key parts given (None = not constrained) are literal filters on the
    view, so Catalyst carries them through the joins and the dedupe's
    grouping key down to the link scan."""
    cond = F.lit(True)
    for col, val in (("from_book", book), ("from_chapter", chapter), ("from_verse", verse)):
        if val is not None:
            cond = cond & (F.col(col) == val)
    return view.filter(cond).orderBy(*link_order()).limit(k)


def top_links_all(edges: DataFrame, n: int = 10) -> DataFrame:
    """O-51: the ``n`` best links of every source in one pass (rank 1..n)."""
    return top_n_per_key(edges, ["from_id"], link_order(), n)


def top_links_readable(edges: DataFrame, from_units: DataFrame, to_units: DataFrame,
                       n: int = 10) -> DataFrame:
    """O-51 over O-36 with readable references, planned for scale.

    Ranking happens after the target join (a dangling target must not take a
    rank) but before the source join: source resolution is all-or-nothing per
    source, so ranking first is exact and the source join sees at most ``n``
    rows per source. The window's hash partitioning on ``from_id`` is reused by
    that join, so only the source dimension is shuffled for it.
    """
    with_to = edges.join(_ends(to_units, "to"), "to_id")
    top = top_links_all(with_to, n)
    return (top.join(_ends(from_units, "from"), "from_id")
            .select("from_id", "rank", "to_id",
                    reference("from_book", "from_chapter", "from_verse").alias("from_ref"),
                    reference("to_book", "to_chapter", "to_verse").alias("to_ref"),
                    "votes"))


def links_by_key(top: DataFrame, key: str = "from_id",
                 fields: Sequence[str] = ("to_ref", "votes")) -> DataFrame:
    """O-52: one row per key with its retained links as ``array<struct>`` in rank order.

    Groups are bounded by the top-n cut that precedes this step.
    """
    items = F.struct(F.col("rank"), *[F.col(f) for f in fields])
    return (top.groupBy(key).agg(F.array_sort(F.collect_list(items)).alias("_l"))
            .select(key, F.transform("_l", lambda s: s.dropFields("rank")).alias("links")))


def out_degree(edges: DataFrame) -> DataFrame:
    """O-50: number of outgoing links per source."""
    return edges.groupBy("from_id").agg(F.count(F.lit(1)).alias("out_degree"))


def expand_ranges(df: DataFrame, start: str, end: str, out: str = "to_verse") -> DataFrame:
    """O-30: one row per verse of an inclusive target range; empty when end < start.

    The guard matters: ``sequence(5, 4)`` would count down to ``[5, 4]``.
    """
    seq = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end))) \
        .otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, F.explode(seq))


def resolve_lines(parsed: DataFrame, from_units: DataFrame, to_units: DataFrame,
                  keep: Sequence[str]) -> DataFrame:
    """O-30, O-31: (file, keep.., to_verse, votes, from_id, to_id) of every verse of a parsed
    statement's range. Nothing is written, and what cannot give a row (unparsed lines, empty
    ranges) meets no shuffle, as do the columns the caller drops."""
    lines = with_default(parsed.filter("matched"), "votes", 0)
    expanded = expand_ranges(lines.join(_ends(from_units, "from"), [
        "from_book", "from_chapter", "from_verse"], "left"), "to_verse_start", "to_verse_end")
    return expanded.join(_ends(to_units, "to"), ["to_book", "to_chapter", "to_verse"], "left") \
        .select("file", *keep, "to_verse", "votes", "from_id", "to_id")


def import_links(parsed: DataFrame, from_units: DataFrame, to_units: DataFrame | None = None,
                 order: Sequence[str] = ("file", "line_no", "to_verse"),
                 only_resolved: bool = False) -> dict[str, DataFrame]:
    """O-30..O-33 end to end: expand ranges, resolve, insert first-wins.

    ``parsed`` comes from ``sources.linkdump`` (one row per statement line, ``matched``
    false for parse failures). The source is resolved once per line, the range is
    expanded with ``posexplode_outer`` (an empty range keeps one row with a NULL target),
    then the target is resolved; votes that are missing or no 64-bit number are 0 (O-17).
    Returns ``edges``
    (from_id, to_id, votes), ``report`` (per file: statements, inserted,
    skipped, unparsed - an unresolved source costs one skip per line, an
    unresolved target one per expanded verse, duplicates are credited to the
    first) and ``resolved`` (the expanded rows of parsed statements), besides the written
    ``rows`` and the ``winners`` with their order. A statement is parsed once.
    With ``only_resolved`` nothing is inserted: ``resolved`` alone is returned, its rows unwritten.
    """
    to_units = from_units if to_units is None else to_units
    at = [c for c in order if c not in ("file", "to_verse")]
    if only_resolved:
        return {"resolved": resolve_lines(parsed, from_units, to_units, at)}
    f, t = _ends(from_units, "from"), _ends(to_units, "to")
    # What cannot match (lines that failed to parse, empty ranges) gets a key of its own instead
    # of a null, so one chain of joins carries everything and no task gets all nulls. NOWHERE
    # keys spread them well enough, and short ones make small shuffle files.
    nowhere = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64("file", *at), F.lit(NOWHERE)).cast("string"))
    lines = with_default(parsed, "votes", 0).withColumn(
        "from_book", F.coalesce("from_book", nowhere))
    per_line = lines.join(f, ["from_book", "from_chapter", "from_verse"], "left")
    rng = F.when(F.col("to_verse_start") <= F.col("to_verse_end"),
                 F.sequence("to_verse_start", "to_verse_end"))
    expanded = per_line.select("*", F.posexplode_outer(rng).alias("_pos", "to_verse"))
    target = expanded.withColumn("to_book", F.when(F.col("to_verse").isNull(), nowhere)
                                 .otherwise(F.col("to_book"))).join(
        t, ["to_book", "to_chapter", "to_verse"], "left")
    # Everything below reads one written copy of the resolved rows.
    rows = written(target.select("file", *at, "to_verse", "votes", "_pos", "matched", F.when(
        F.col("matched"), F.col("from_id")).alias("from_id"), F.when(
        F.col("matched"), F.col("to_id")).alias("to_id")), "resolved", "zstd")

    winners = first_per_key(
        rows.filter(F.col("from_id").isNotNull() & F.col("to_id").isNotNull())
        .select("from_id", "to_id", "votes", *order), ["from_id", "to_id"], order)
    edges = winners.select("from_id", "to_id", "votes")
    resolved = rows.filter("matched").filter(F.col("to_verse").isNotNull()).drop("_pos", "matched")
    return {"edges": edges, "report": _import_report(rows, winners), "resolved": resolved,
            "rows": rows, "winners": winners}


def _import_report(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """O-33: (file, lines_processed, imported, skipped, unparsed); every statement line has
    one row without or with the first place of its range."""
    first_of_line = F.col("_pos").isNull() | (F.col("_pos") == 0)
    lines = rows.groupBy("file").agg(
        F.count_if(first_of_line).alias("lines_processed"),
        F.count_if(F.col("matched") & F.col("from_id").isNull() & first_of_line).alias("_skip_from"),
        F.count_if(F.col("from_id").isNotNull() & F.col("to_verse").isNotNull()
                   & F.col("to_id").isNull()).alias("_skip_to"),
        F.count_if(~F.col("matched")).alias("unparsed"))
    imported = winners.groupBy("file").agg(F.count(F.lit(1)).alias("imported"))
    return (lines.join(imported, "file", "left").na.fill(0, ["imported"])
            .select("file", "lines_processed", "imported",
                    (F.col("_skip_from") + F.col("_skip_to")).alias("skipped"), "unparsed"))
