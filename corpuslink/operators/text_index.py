"""A trigram index for substring search (O-39): the answer of ``query.search_text`` without a scan.

``build_text_index`` writes the units in parts (ranges of their id, a folder each), numbered in
blocks of ``BLOCK``, and a table of postings: for every three characters in a row of the
lower-cased text and every block, the numbers of the units that hold them, as one list. The postings
are dealt by trigram and sorted by it, so that pages of other trigrams are skipped by their
statistics. A search looks up how many units hold each trigram of the needle, intersects the
postings of the rarest ones, reads the parts that are left and applies the exact filter there.
A needle of fewer than three characters has no trigram and scans the units.

Scale: a posting is two bytes of a list, not a row; a task finds the trigrams of a chunk of units
by one sort of numbers, and only lists are shuffled, so a trigram that all units hold is a row a
block. The driver sees the needle's trigrams with their counts and the numbers of the parts to
read, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import grid
from corpuslink.operators.query import UNIT_ORDER, search_text
from corpuslink.session import written

INTERSECTED = 4                 # of a needle's trigrams; the exact filter checks the rest
BLOCK = 1 << 15                 # units of a block: a number in it takes two bytes
CHUNK_ROWS = 1 << 14            # units whose trigrams a task sorts at once


def trigrams(text: Column) -> Column:
    """The distinct three-character pieces of the lower-cased text, as code points."""
    def pieces(chars: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(chars)), lambda i: i <= F.size(chars) - 3)
        return F.transform(places, lambda i: F.concat(
            F.get(chars, i), F.get(chars, i + 1), F.get(chars, i + 2)))
    # inside a one-element array the characters are cut once, not once a piece
    return F.array_distinct(F.get(F.transform(F.array(F.split(F.lower(text), "")), pieces), 0))


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, the text of each)."""
    found = texts.to_pylist()
    return (np.frombuffer("".join(found).encode("utf-32-le"), "<u4").astype(np.int64),
            np.repeat(np.arange(len(found)), [len(t) for t in found]))


def _postings(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(tri, part, block, n, units) of ``table(part, block, number, low)``: the trigrams of each
    run of units of a block, with the numbers of the units that hold them."""
    for at in range(0, table.num_rows, CHUNK_ROWS):
        piece = table.slice(at, CHUNK_ROWS).combine_chunks()
        part, block, number = (grid._one(piece, c).to_numpy() for c in ("part", "block", "number"))
        chars, owner = _characters(grid._one(piece, "low"))
        starts = np.flatnonzero(owner[:-2] == owner[2:]) if len(owner) > 2 else owner[:0]
        if not len(starts):
            continue
        present = np.zeros(0x110000, bool)             # numbers for the characters in use
        present[chars] = True
        letters = np.flatnonzero(present)
        rank = (np.cumsum(present) - 1)[chars]
        n = len(letters)
        key = (rank[starts] * n + rank[starts + 1]) * n + rank[starts + 2]
        if n ** 3 * len(part) >= 1 << 63:
            named, key = np.unique(key, return_inverse=True)
        else:
            named = None
        both = np.sort(key * len(part) + owner[starts])              # by trigram, then unit
        both = both[np.flatnonzero(np.diff(both, prepend=-1))]
        key, unit = np.divmod(both, len(part))
        run = np.cumsum(np.diff(block, prepend=block[:1]) != 0)[unit]
        first = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(run, prepend=-1) != 0))
        key = key[first] if named is None else named[key[first]]
        tri = letters[np.stack([key // (n * n), key // n % n, key % n], 1)]
        tri = tri.astype("<u4").tobytes().decode("utf-32-le")
        ends = np.append(first, len(unit)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([tri[k:k + 3] for k in range(0, len(tri), 3)], pa.string()),
             pa.array(part[unit[first]]), pa.array(block[unit[first]]), pa.array(np.diff(ends)),
             pa.ListArray.from_arrays(ends, pa.array(number[unit]))],
            names=["tri", "part", "block", "n", "units"])


def build_text_index(units: DataFrame, path: str, parts: int | None = None) -> None:
    """Write the index of ``units(verse_id, text, ..)``; units without text have no postings."""
    spark = units.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts or tasks
    tasks = n * -(-tasks // n)                         # a part is written by several tasks
    # a task numbers its rows from its own number times 2 ** 33
    place = F.monotonically_increasing_id()
    units.repartitionByRange(tasks, "verse_id").withColumns({
        "block": F.floor(place / BLOCK), "number": (place % BLOCK).cast("smallint"),
        "part": F.least(F.floor(F.spark_partition_id() * n / tasks), F.lit(n - 1)).cast("int")}) \
        .write.mode("overwrite").partitionBy("part").parquet(f"{path}/units")
    stored = spark.read.parquet(f"{path}/units").where(F.col("text").isNotNull()).select(
        "part", "block", "number", F.make_valid_utf8(F.lower("text")).alias("low"))
    grid.mapped(stored, _postings, "tri string, part int, block bigint, n int, "
                "units array<smallint>").repartition("tri").sortWithinPartitions(
        "tri", "block").write.mode("overwrite").parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("tri").agg(F.sum("n").alias("n")) \
        .repartitionByRange("tri").sortWithinPartitions("tri").write.mode("overwrite").parquet(
        f"{path}/counts")


def candidates(spark: SparkSession, path: str, needle: str) -> DataFrame | None:
    """(part, block, number) of the units that hold the needle's rarest trigrams; None where the
    needle has none."""
    wanted = spark.range(1).select(trigrams(F.lit(needle))).first()[0]
    if not wanted:
        return None
    found = spark.read.parquet(f"{path}/counts").where(F.col("tri").isin(wanted)).collect()
    rarest = [r.tri for r in sorted(found, key=lambda r: (r.n, r.tri))][:INTERSECTED]
    postings = spark.read.parquet(f"{path}/postings")
    rows = postings.select("tri", "part", "block", F.explode("units").alias("number"))
    if len(found) < len(wanted):                       # a trigram that no unit holds
        return rows.drop("tri").limit(0)
    rows = rows.where(F.col("tri").isin(rarest)).groupBy("part", "block", "number").agg(
        F.count(F.lit(1)).alias("held")).where(F.col("held") == len(rarest)).drop("held")
    return rows


def search_index(spark: SparkSession, path: str, needle: str, n: int | None = None,
                 order: Sequence[str] = UNIT_ORDER) -> DataFrame:
    """O-39 through the index: the first ``n`` units in ``order``, or all."""
    units = spark.read.parquet(f"{path}/units")
    rows = candidates(spark, path, needle)
    if rows is not None:
        rows = written(rows, "text-candidates")
        parts = [r.part for r in rows.select("part").distinct().collect()]
        units = units.where(F.col("part").isin(parts)).join(
            rows, ["part", "block", "number"], "left_semi")
    return search_text(units.drop("part", "block", "number"), needle, n, order)
