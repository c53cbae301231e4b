"""The persisted search index of a strategy (O-69), with appends, deletions and folding.

``<path>/<strategy>/pointers`` holds a row per version; the newest names everything the index
consists of: the cells' folder, one segment of vectors for each append, one list of ids for each
deletion, and the index's facts (model, dimension, probes). A change writes its own
folders first and then adds one pointer row, so it is there whole or not at all: what a
stopped writer left behind no pointer names. Readers that hold an older version keep it.

An id counts by its latest change: appended again, its vector is replaced; deleted, it is gone until
it is appended again. Reading settles that with the changes alone (all that came after the
first segment): the first segment is anti-joined with their ids and never shuffled when AQE
can broadcast them. ``fold_index`` writes the live vectors as one segment, clustered by cell.

One writer at a time: two pointer rows of one version are an error that reading reports.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.vector import nearest_centroid, normalize

CHANGE = "struct<kind:string,folder:string,seq:bigint>"
POINTER = (f"version long, cells string, changes array<{CHANGE}>, model_name string, "
           "dimension int, nprobe int")


def _pointer(spark: SparkSession, base: str):
    """The newest pointer row; None before the first."""
    try:
        rows = spark.read.schema(POINTER).json(f"{base}/pointers").orderBy(
            F.desc("version")).limit(2).collect()
    except AnalysisException:
        return None
    if len(rows) > 1 and rows[0].version == rows[1].version:
        raise ValueError(f"two writers committed version {rows[0].version} of {base}")
    return rows[0] if rows else None


def _commit(spark: SparkSession, base: str, row: tuple) -> None:
    spark.createDataFrame([row], POINTER).coalesce(1).write.json(f"{base}/pointers", mode="append")


def _segment(vectors: DataFrame, base: str) -> str:
    """Write normalised vectors with their cells, clustered by cell; files follow the data, not
    the cells, and a probe of few cells skips the others by their statistics."""
    name = uuid.uuid4().hex
    vectors.select("verse_id", F.col("vec").cast("array<float>").alias("vec"), "cell") \
        .repartitionByRange("cell", "verse_id").sortWithinPartitions("cell").write.parquet(
        f"{base}/segments/{name}")
    return name


def save_index(index: dict, path: str, strategy: str = "text_only", model_name: str = "") -> None:
    """O-69: the index as built, in place of what the strategy had before."""
    vectors = normalize(index["vectors"])
    spark, base = vectors.sparkSession, f"{path}/{strategy}"
    last = _pointer(spark, base)
    version = last.version + 1 if last else 1
    cells = uuid.uuid4().hex
    index["cells"].write.parquet(f"{base}/cells/{cells}")
    segment = _segment(vectors, base)
    dimension = spark.read.parquet(f"{base}/segments/{segment}").agg(F.max(F.size("vec"))).first()[0]
    _commit(spark, base, (version, cells, [("vectors", segment, version)], model_name, dimension,
                          index.get("nprobe")))


def append_vectors(spark: SparkSession, path: str, vecs: DataFrame, strategy: str = "text_only"
                   ) -> None:
    """Add ``vecs(verse_id, vec)``, one row an id, to the cells as they are; known ids are replaced."""
    base, last = f"{path}/{strategy}", _pointer(spark, f"{path}/{strategy}")
    cells = spark.read.parquet(f"{base}/cells/{last.cells}")
    sizes = vecs.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if sizes[0] is not None and last.dimension is not None and set(sizes) != {last.dimension}:
        raise ValueError(f"vectors of size {sorted(set(sizes))} for an index of {last.dimension}")
    segment = _segment(nearest_centroid(normalize(vecs), cells, "cell"), base)
    _commit(spark, base, (last.version + 1, last.cells, [
        *last.changes, ("vectors", segment, last.version + 1)], last.model_name,
        last.dimension or sizes[0], last.nprobe))


def delete_vectors(spark: SparkSession, path: str, ids: DataFrame, strategy: str = "text_only"
                   ) -> None:
    """Take the vectors of ``ids(verse_id)`` out; unknown ids change nothing."""
    base, last = f"{path}/{strategy}", _pointer(spark, f"{path}/{strategy}")
    name = uuid.uuid4().hex
    ids.select("verse_id").distinct().write.parquet(f"{base}/deleted/{name}")
    _commit(spark, base, (last.version + 1, last.cells, [
        *last.changes, ("deleted", name, last.version + 1)], last.model_name, last.dimension,
        last.nprobe))


def _live(spark: SparkSession, base: str, changes) -> DataFrame:
    """(verse_id, vec, cell) by each id's latest change."""
    first = spark.read.parquet(f"{base}/segments/{changes[0].folder}")
    if len(changes) == 1:
        return first
    later = None
    for c in changes[1:]:
        folder = "segments" if c.kind == "vectors" else "deleted"
        rows = spark.read.parquet(f"{base}/{folder}/{c.folder}").withColumn("seq", F.lit(c.seq))
        if c.kind == "deleted":
            rows = rows.select("verse_id", F.lit(None).cast("array<float>").alias("vec"),
                               F.lit(None).cast("long").alias("cell"), "seq",
                               F.lit(True).alias("gone"))
        else:
            rows = rows.select("verse_id", "vec", "cell", "seq", F.lit(False).alias("gone"))
        later = rows if later is None else later.union(rows)
    latest = later.groupBy("verse_id").agg(F.max_by(F.struct("vec", "cell", "gone"), "seq").alias("x"))
    return first.join(later.select("verse_id"), "verse_id", "left_anti").unionByName(
        latest.where(~F.col("x.gone")).select("verse_id", "x.vec", "x.cell"))


def load_index(spark: SparkSession, path: str, strategy: str = "text_only") -> dict | None:
    """O-69: the newest version of a strategy's index as {'vectors', 'cells', 'nprobe', 'meta'};
    a missing strategy returns None (the reference skips it and goes on)."""
    base = f"{path}/{strategy}"
    last = _pointer(spark, base)
    if last is None:
        return None
    vectors = _live(spark, base, last.changes)
    meta = vectors.agg(F.lit(last.model_name).alias("model_name"), F.lit(last.dimension).alias(
        "dimension"), F.count(F.lit(1)).alias("n_vectors"), F.lit(last.version).alias("version"))
    found = {"vectors": vectors, "cells": spark.read.parquet(f"{base}/cells/{last.cells}"),
             "meta": meta}
    return found | ({"nprobe": last.nprobe} if last.nprobe else {})


def fold_index(spark: SparkSession, path: str, strategy: str = "text_only") -> None:
    """Write the live vectors as one segment; the answers stay the same."""
    base, last = f"{path}/{strategy}", _pointer(spark, f"{path}/{strategy}")
    if last is None or len(last.changes) == 1:
        return
    segment = _segment(_live(spark, base, last.changes), base)
    _commit(spark, base, (last.version + 1, last.cells, [("vectors", segment, last.version + 1)],
                          last.model_name, last.dimension, last.nprobe))
