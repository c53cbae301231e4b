"""Vector search (O-64, O-65, O-67, O-69..O-72, O-81).

Vectors are ``array<float>`` columns keyed by ``verse_id`` - never aligned by
position. Scores are cosine (D2): stored vectors and queries are normalised on
entry, whatever their length; vectors of unequal size raise an error (D1).

Scale notes:
* the vectors are scanned once and never shuffled before the top-k cut: a task
  multiplies chunks of them by the blocks of queries, read from a shared table
  (``operators.grid``), so both sides are distributed and may have any size;
* the approximate paths find each query's nearest cells (IVF, here) or probe
  buckets of hyperplane signatures (``operators.lsh``) and score only what lies there.

The caller names exact or approximate search; nothing switches by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.vectors import dot, l2_normalize
from corpuslink.operators import grid
from corpuslink.operators.query import filter_units, top_n_per_key
from corpuslink.session import written

OVERFETCH = 10               # O-70: the reference fetches 10 * k before filtering
BLOCK_BYTES = grid.BLOCK_BYTES


def normalize(vecs: DataFrame, col: str = "vec", out: str | None = None) -> DataFrame:
    """O-64: L2-normalise a vector column (zero vectors unchanged)."""
    return vecs.withColumn(out or col, l2_normalize(col))


def score(vecs: DataFrame, query: DataFrame, vec_col: str = "vec",
          qvec_col: str = "qvec") -> DataFrame:
    """Cosine score of every vector against a one-row query frame, attached as a
    scalar subquery (callers build it with a global aggregate: one row)."""
    # Bound to a column first: subqueries may not appear inside lambdas.
    q = query.select(l2_normalize(qvec_col)).scalar()
    return vecs.withColumn("_q", q).withColumn("score", dot(l2_normalize(vec_col), "_q")).drop("_q")


def query_vector(df: DataFrame, vec_col: str = "vec", normalize_it: bool = True) -> DataFrame:
    """One-row frame ``qvec`` holding the mean of ``vec_col`` over ``df`` (normalised).

    ``df`` may have any size: the mean is computed by a partial aggregate per
    dimension. With exactly one row this is that row's vector.
    """
    c = centroids(df.withColumn("_g", F.lit(0)), "_g", vec_col)
    q = c.select(F.col("centroid").alias("qvec"))
    # A global aggregate always yields one row, even for an empty input.
    one = q.agg(F.first("qvec", ignorenulls=True).alias("qvec"))
    return one.select(l2_normalize("qvec").alias("qvec")) if normalize_it else one


def search(vecs: DataFrame, query: DataFrame, k: int = 10, testament: str | None = None,
           books: Sequence[str] | None = None, min_score: float = 0.0,
           mode: str = "pre") -> DataFrame:
    """O-70 (+O-42, O-43): filtered similarity search for one query.

    ``mode='pre'`` (default, exact): filter, score, keep score >= min_score,
    take k. ``mode='overfetch'`` (parity, D11): rank everything, keep the first
    ``OVERFETCH * k``, then filter, then take k - may return fewer than k.
    Ties are broken by ``verse_id``; the threshold meets the score itself, which
    is then rounded to 6 places for ordering, so results are stable across engines.
    """
    order = [F.desc("score"), F.asc("verse_id")]
    if mode == "pre":
        cand = score(filter_units(vecs, testament, books), query)
        return (cand.filter(F.col("score") >= min_score)
                .withColumn("score", F.round("score", 6)).orderBy(*order).limit(k))
    if mode == "overfetch":
        s = score(vecs, query).withColumn("_raw", F.col("score")) \
            .withColumn("score", F.round("score", 6))
        top = s.orderBy(*order).limit(OVERFETCH * k)
        top = filter_units(top, testament, books).filter(F.col("_raw") >= min_score).drop("_raw")
        return top.orderBy(*order).limit(k)
    raise ValueError(f"unknown mode {mode}")


def find_similar(vecs: DataFrame, key_filter, k: int = 10) -> DataFrame:
    """O-71: the k nearest other units of the unit selected by ``key_filter``.

    The unit is excluded by id (D4), not by dropping the first hit; an unknown
    key yields an empty result.
    """
    me = vecs.filter(key_filter)
    q = query_vector(me.select("vec"), normalize_it=True)
    ids = me.select(F.col("verse_id").alias("_self"))
    s = score(vecs.join(ids, vecs["verse_id"] == ids["_self"], "left_anti"), q)
    return (s.filter(F.col("score").isNotNull()).withColumn("score", F.round("score", 6))
            .orderBy(F.desc("score"), F.asc("verse_id")).limit(k))


def topk_exact(vecs: DataFrame, queries: DataFrame, k: int, qid: str = "qid",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """O-65 for many queries ``queries(qid, qvec)``: the k best vectors of each.

    Result: (qid, rank, verse_id, score). The vectors are scanned once; the tasks read the
    queries in blocks from a shared table (``operators.grid``).
    """
    unit = vecs.where(F.col("vec").isNotNull()).select(
        F.lit(0).alias("key"), "verse_id", l2_normalize("vec").alias("vec"))
    asked = queries.select(F.lit(0).alias("key"), F.col(qid).alias("id"),
                           l2_normalize("qvec").alias("vec"))
    return _topk_by_key(unit, asked, k, qid, block_bytes, keyed=False)


def _topk_by_key(unit: DataFrame, asked: DataFrame, k: int, qid: str, block_bytes: int,
                 keyed: bool = True) -> DataFrame:
    """The k best of ``unit(key, verse_id, vec)`` for each of ``asked(key, id, vec)``."""
    schema = (f"`{qid}` {asked.schema['id'].dataType.simpleString()}, "
              f"verse_id {unit.schema['verse_id'].dataType.simpleString()}, score double")
    blocks = grid.write_blocks(asked.where(F.col("vec").isNotNull()), block_bytes, keyed)
    s = grid.topk_against(unit, blocks, k, qid, schema)
    return top_n_per_key(s, [qid], [F.desc("score"), F.asc("verse_id")], k) \
        .select(qid, "rank", "verse_id", "score")


def centroids(vecs: DataFrame, group: str, vec_col: str = "vec") -> DataFrame:
    """Mean vector per group: ``(group, centroid array<double>)``; null vectors do not count.

    Whole vectors are summed by a partial aggregate in the JVM, so a group holding a third of
    all rows is one row a task before the shuffle.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    known = vecs.where(F.col(vec_col).isNotNull()).select(group, array_to_vector(
        F.col(vec_col).cast("array<double>")).alias("_v"))
    return known.groupBy(group).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(
        group, vector_to_array("_m").alias("centroid"))


def nearest_centroid(vecs: DataFrame, cents: DataFrame, cluster: str = "cluster",
                     vec_col: str = "vec", out: str | None = None,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Assign each vector to the centroid with the highest cosine (ties: lower id).

    One pass of matrix products against the centroids' blocks; the vectors are not
    shuffled.
    """
    out = out or cluster
    rest = [c for c in vecs.columns if c != out]
    blocks = grid.write_blocks(cents.where(F.col("centroid").isNotNull()).select(
        F.lit(0).alias("key"), F.col(cluster).cast("long").alias("id"),
        l2_normalize("centroid").alias("vec")), block_bytes)
    df = vecs.select(*rest, l2_normalize(vec_col).alias("_v"))
    return grid.nearest(df, blocks, "_v", "_c").select(*rest, F.col("_c").alias(out))


# --- approximate search (IVF) -------------------------------------------------

def build_ivf(vecs: DataFrame, nlist: int, seed: int = 42, max_iter: int = 10,
              target_recall: float | None = 0.9, recall_k: int = 10, sample: int = 256) -> dict:
    """O-67/O-69: train ``nlist`` cells with Spark ML k-means over normalised
    vectors and attach the cell id. Returns {'vectors', 'cells', 'nprobe'}."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    # Coarse cells only steer the probe, so random initialisation (no k-means||
    # passes) is enough; probing every cell stays exact whatever the cells.
    feats = vecs.select(array_to_vector(l2_normalize("vec")).alias("features")).persist(
        StorageLevel.MEMORY_AND_DISK)
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, initMode="random",
                   featuresCol="features").fit(feats)
    feats.unpersist()
    spark = vecs.sparkSession
    cells = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "cell long, centroid array<double>")
    return ivf_from_cells(vecs, cells, target_recall, recall_k, sample)


def ivf_from_cells(vecs: DataFrame, cells: DataFrame, target_recall: float | None = 0.9,
                   recall_k: int = 10, sample: int | None = 256) -> dict:
    """O-67 over given ``cells(cell, centroid)``: the index as ``build_ivf`` returns it.

    ``nprobe``, how many cells a search probes unless told otherwise, is the least number that
    finds ``target_recall`` of the ``recall_k`` nearest vectors of ``sample`` of the vectors
    themselves, those with the smallest hash of their id (``None``: of all of them). Without a
    target every search names its own.
    """
    cells = cells.select("cell", l2_normalize("centroid").alias("centroid"))
    dealt = written(nearest_centroid(normalize(vecs), cells, "cell"), "ivf")
    if target_recall is None:
        return {"vectors": dealt, "cells": cells}
    asked = dealt.where(F.col("vec").isNotNull()).select(
        F.col("verse_id").alias("qid"), F.col("vec").alias("qvec"))
    if sample is not None:
        asked = asked.orderBy(F.xxhash64("qid"), "qid").limit(sample)
    index = {"vectors": dealt, "cells": cells}
    index["nprobe"] = cells_needed(index, written(asked, "probes"), recall_k, target_recall)
    return index


def cells_needed(index: dict, queries: DataFrame, k: int, target_recall: float,
                 qid: str = "qid") -> int:
    """The least number of cells to probe so that ``target_recall`` of all exact hits of
    ``queries`` lie in them: a quantile of the hits' cells in the order of the query's probes."""
    n = index["cells"].count()
    hits = topk_exact(index["vectors"], queries, k, qid).join(
        index["vectors"].select("verse_id", "cell"), "verse_id")
    order = _probed_cells(index, queries, n, qid)
    at = hits.join(order, [qid, "cell"]).groupBy("rank_of_cell").count().orderBy("rank_of_cell")
    counts = [(r.rank_of_cell, r["count"]) for r in at.collect()]       # a row a cell at most
    total, seen = sum(c for _, c in counts), 0
    for rank, c in counts:
        seen += c
        if seen >= target_recall * total:
            return rank
    return max(1, n)


def _probed_cells(index: dict, queries: DataFrame, nprobe: int, qid: str) -> DataFrame:
    """(qid, cell, rank_of_cell): each query's nearest cells, by the rule that dealt the vectors."""
    cells = index["cells"].select(F.col("cell").alias("verse_id"), F.col("centroid").alias("vec"))
    return topk_exact(cells, queries, nprobe, qid).select(
        qid, F.col("verse_id").alias("cell"), F.col("rank").alias("rank_of_cell"))


def topk_ann(index: dict, queries: DataFrame, k: int, nprobe: int | None = None,
             qid: str = "qid") -> DataFrame:
    """O-67: probe the ``nprobe`` nearest cells of each query (highest cosine, ties to the lower
    cell; default: as many as the index found necessary), then exact re-rank inside them.

    The probes lie in a shared table sorted by cell, and a chunk of vectors multiplies each of
    its cells with that cell's probes (``operators.grid``): no row for a (vector, query)
    pair, and a hot cell is spread over the chunks that hold it. With ``nprobe`` = all cells
    the result equals ``topk_exact``."""
    near = _probed_cells(index, queries, nprobe or index["nprobe"], qid)
    probe = queries.select(qid, l2_normalize("qvec").alias("vec")).join(near, qid).select(
        F.col("cell").alias("key"), F.col(qid).alias("id"), "vec")
    unit = index["vectors"].where(F.col("cell").isNotNull()).select(
        F.col("cell").alias("key"), "verse_id", l2_normalize("vec").alias("vec"))
    return _topk_by_key(unit, probe, k, qid, BLOCK_BYTES)


def recall_at_k(approx: DataFrame, exact: DataFrame, qid: str = "qid") -> DataFrame:
    """O-81: share of exact hits that the approximate search also returned."""
    hit = exact.join(approx.select(qid, "verse_id"), [qid, "verse_id"], "left_semi")
    n_hit = hit.agg(F.count(F.lit(1))).scalar()
    return (exact.agg(F.count(F.lit(1)).alias("n_exact"))
            .select("n_exact", n_hit.alias("n_hit"))
            .withColumn("recall", F.col("n_hit") / F.col("n_exact")))
