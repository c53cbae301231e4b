"""Clustering into themes (O-75..O-80).

K-means with all restarts at once: an iteration is one scan of the vectors, in which each task
assigns its chunk under every restart's centres by one matrix product and sums vectors and
counts per centre; the sums (restarts x k rows) meet on the driver, which moves the centres.
Everything after the fit is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.functions.vectors import dot, l2_normalize
from corpuslink.operators import grid
from corpuslink.operators.query import top_n_per_key

# Fixed values of the reference's theme text.
THEME_PREFIX = "Theme from "
THEME_MORE = ", etc."
THEME_BOOKS = 3


SAMPLE = 4096                   # vectors from which each restart draws its first centres
TOLERANCE = 1e-4                # a restart whose centres all move less is done


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: k rows of the sample, each drawn by its squared distance from those before."""
    draw = np.random.default_rng(seed)
    chosen = [sample[draw.integers(len(sample))]]
    far = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        weight = far / far.sum() if far.sum() > 0 else None          # fewer than k unlike rows
        chosen.append(sample[draw.choice(len(sample), p=weight)])
        far = np.minimum(far, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.stack(chosen)


def _pass(train: DataFrame, centres: np.ndarray, going: np.ndarray) -> tuple:
    """(cost per restart, counts, sums) of one scan under the ``going`` restarts' centres."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    restarts, k, dim = centres.shape
    bc = train.sparkSession.sparkContext.broadcast((centres, going))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, going = bc.value
        total = np.zeros((restarts * k, dim + 2))                    # sums, count, cost
        for table in grid.chunked(batches, grid.CHUNK_BYTES):
            matrix = grid.matrix_of(table.column("vec").chunk(0))
            for at in range(0, len(matrix), grid.TILE_VECTORS):
                x = matrix[at:at + grid.TILE_VECTORS]
                norm = (x * x).sum(axis=1)
                for r in going:
                    c = centres[r]
                    gap = (c * c).sum(axis=1) - 2 * grid.products(x, c)
                    near = gap.argmin(axis=1)
                    far = np.maximum(norm + gap[np.arange(len(x)), near], 0)
                    into = r * k + near
                    hot = np.zeros((len(x), k))
                    hot[np.arange(len(x)), near] = 1
                    total[r * k:(r + 1) * k, :dim] += hot.T @ x
                    total[:, dim] += np.bincount(into, minlength=restarts * k)
                    total[:, dim + 1] += np.bincount(into, far, restarts * k)
        rows = np.flatnonzero(total[:, dim])
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.ListArray.from_arrays(
            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (dim + 2)),
            pa.array(total[rows].ravel()))], names=["centre", "part"])

    found = train.mapInArrow(run, "centre long, part array<double>").groupBy("centre").agg(
        vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part")).collect()
    bc.unpersist()
    total = np.zeros((restarts * k, dim + 2))
    for centre, part in found:                                       # restarts x k rows
        total[centre] = part
    total = total.reshape(restarts, k, dim + 2)
    return total[:, :, dim + 1].sum(axis=1), total[:, :, dim], total[:, :, :dim]


def fit_centres(train: DataFrame, k: int, seed: int, n_init: int, max_iter: int
                ) -> tuple[np.ndarray, float]:
    """The best of ``n_init`` restarts over ``train(verse_id, vec)`` and its cost, the sum of
    squared distances to the nearest centre. A centre that loses all its vectors stays."""
    sample = np.array([r.vec for r in train.orderBy(F.xxhash64("verse_id"), "verse_id")
                       .limit(SAMPLE).select("vec").collect()], np.float64)
    if not len(sample):
        return np.zeros((0, 0)), 0.0
    centres = np.stack([first_centres(sample, k, seed + i) for i in range(n_init)])
    going, cost = np.arange(n_init), np.full(n_init, np.inf)
    for i in range(max_iter + 1):
        now, counts, sums = _pass(train, centres, going)
        cost[going] = now[going]
        if i == max_iter:
            break
        moved = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centres)
        shift = np.sqrt(((moved - centres) ** 2).sum(axis=2)).max(axis=1)
        still = going[shift[going] > TOLERANCE]
        centres[still] = moved[still]
        going = still
        if not len(going):
            break
    best = int(cost.argmin())
    return centres[best], float(cost[best])


def cluster(vecs: DataFrame, k: int = 10, seed: int = 42, n_init: int = 10,
            max_iter: int = 20) -> dict:
    """O-75/O-80: k-means over the normalised vectors with ``n_init`` restarts.

    Returns {'assigned': vecs + cluster, 'centroids': (cluster, centroid), 'cost'}.
    Sizes of the result always sum to the number of vectors that are not null.
    """
    unit = vecs.where(F.col("vec").isNotNull()).select(
        "verse_id", l2_normalize("vec").alias("vec")).persist(StorageLevel.MEMORY_AND_DISK)
    centres, cost = fit_centres(unit, k, seed, n_init, max_iter)
    unit.unpersist()
    spark = vecs.sparkSession
    cents = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)],
                                  "cluster long, centroid array<double>")
    return {"assigned": assign_nearest(vecs, cents), "centroids": cents, "cost": cost}


def assign_nearest(vecs: DataFrame, cents: DataFrame) -> DataFrame:
    """``vecs`` with ``cluster``, the centre at the least distance from the normalised vector
    (ties: the lower id): the greatest product once the vectors get a 1 and the centres minus
    half their squared length as one more number."""
    half = F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x * x) / -2
    blocks = grid.write_blocks(cents.select(F.lit(0).alias("key"), F.col("cluster").alias("id"), F.concat(
        "centroid", F.array(half)).alias("vec")))
    rest = [c for c in vecs.columns if c != "cluster"]
    df = vecs.select(*rest, F.concat(l2_normalize("vec"), F.array(F.lit(1.0))).alias("_v"))
    return grid.nearest(df, blocks, "_v", "_c").select(*rest, F.col("_c").alias("cluster"))


def cluster_units(vecs: DataFrame, k: int = 50, seed: int = 42) -> DataFrame:
    """O-80: the raw cluster listing - every unit with its cluster, no themes."""
    return cluster(vecs, k=k, seed=seed, n_init=1)["assigned"].select("verse_id", "cluster")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("num_verses"))


def representatives(assigned: DataFrame, cents: DataFrame, n: int = 5) -> DataFrame:
    """O-76: the ``n`` members closest (cosine) to their normalised centroid."""
    c = cents.select("cluster", l2_normalize("centroid").alias("_cv"))
    s = (assigned.join(c, "cluster")
         .withColumn("score", F.round(dot(l2_normalize("vec"), "_cv"), 6)).drop("_cv"))
    return top_n_per_key(s, ["cluster"], [F.desc("score"), F.asc("verse_id")], n)


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """O-77: size and Old count per cluster; everything else counts as New."""
    return (assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("num_verses"),
        F.count_if(F.col("testament") == "Old").alias("n_old"))
        .withColumn("n_new", F.col("num_verses") - F.col("n_old")))


def theme_label(reps: DataFrame, book_col: str = "book_name") -> DataFrame:
    """O-78: 'Theme from A, B, C' over the representatives' distinct books, sorted
    alphabetically (D6), with ', etc.' when there are more than three."""
    books = reps.groupBy("cluster").agg(F.array_sort(F.collect_set(book_col)).alias("_b"))
    text = F.concat(F.lit(THEME_PREFIX), F.array_join(F.slice("_b", 1, THEME_BOOKS), ", "),
                    F.when(F.size("_b") > THEME_BOOKS, F.lit(THEME_MORE)).otherwise(F.lit("")))
    return books.select("cluster", text.alias("description"))


def themes(profile: DataFrame, labels: DataFrame) -> DataFrame:
    """O-79: themes ranked by size desc (ties by id). k rows, so the global
    window is cheap."""
    t = profile.join(labels, "cluster", "left").withColumnRenamed("cluster", "theme_id")
    w = Window.orderBy(F.desc("num_verses"), F.asc("theme_id"))
    return t.withColumn("theme_rank", F.row_number().over(w))


def discover(vecs: DataFrame, k: int = 10, n: int = 5, seed: int = 42, n_init: int = 10
             ) -> DataFrame:
    """O-75..O-79 end to end: vectors (verse_id, book_name, testament, reference, vec) to
    ranked themes with their labels and the references of their ``n`` representatives."""
    found = cluster(vecs, k=k, seed=seed, n_init=n_init)
    assigned = found["assigned"].persist(StorageLevel.MEMORY_AND_DISK)
    reps = representatives(assigned, found["centroids"], n)
    listed = reps.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "reference"))).alias("_l")).select(
        F.col("cluster").alias("theme_id"),
        F.transform("_l", lambda s: s["reference"]).alias("representatives"))
    return themes(cluster_profile(assigned), theme_label(reps)).join(listed, "theme_id", "left")
