"""Scoring vectors against many queries with both sides distributed (O-65, O-67, O-75).

The queries lie in a shared table, sorted by key and cut into files of ``BLOCK_BYTES``. A task
holds a chunk of its vectors and reads the blocks that its keys meet, one after another, so
the grid of (chunk x block) products is spread over the tasks of one scan of the vectors:
nothing passes the driver but the blocks' names and key ranges (a row for each 32 MB of queries),
and the vectors are not shuffled. Without keys every block meets every chunk. A
chunk emits the k best vectors of each query of a block, whatever the sizes.

Block files are read inside tasks from the shared scratch folder (``spark.checkpoint.dir``)
through pyarrow, by the folder's URI; a lost task reads them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.session import scratch_path

BLOCK_BYTES = 32 << 20       # of a block of queries
BLOCK_DIM = 1024
CHUNK_BYTES = 64 << 20       # of the vectors a task holds at once
TILE_QUERIES, TILE_VECTORS = 1024, 4096
ROUNDING = 2e-6              # scores this far apart keep their order at 6 places
SINGLE = 2.0 ** -23          # of a single-precision product, by length of the vectors
PAIRS, PAIRS_SHARE = 8192, 64   # made again at once in double precision; above this share, all
CROWD = 4                    # times k: so many pairs of a tile are sorted without a cut

#: The last block a worker read: a single block is read once per worker, not once a chunk.
_last: dict[str, tuple] = {}


def write_blocks(rows: DataFrame, block_bytes: int = BLOCK_BYTES, keyed: bool = False
                 ) -> list[tuple]:
    """Write ``rows(key, id, vec)`` as block files; (file, least key, greatest key) of each.

    ``vec`` is an array of doubles without nulls. A file has the rows that make ``block_bytes``
    at ``BLOCK_DIM`` numbers each. ``keyed`` rows are sorted by key over all files; without keys
    (None for both bounds) every block meets every vector and one job writes them.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, f"blocks-{uuid.uuid4().hex}")
    rows = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id") if keyed \
        else rows.hint("rebalance")
    rows.write.option("maxRecordsPerFile", max(1, block_bytes // (8 * BLOCK_DIM))).parquet(path)
    files = spark.read.schema(rows.schema).parquet(path)
    if not keyed:
        return [(f, None, None) for f in sorted(files.inputFiles())]
    found = files.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("key").alias("lo"), F.max("key").alias("hi"))
    return [(r.f, r.lo, r.hi) for r in found.orderBy("lo", "hi", "f").collect()]


def matrix_of(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix; vectors of unequal size raise (D1)."""
    if not len(column):
        return np.zeros((0, 0))
    sizes = pc.list_value_length(column)
    if pc.min(sizes).as_py() != pc.max(sizes).as_py():
        raise ValueError("vectors of unequal size")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def read_columns(file: str, columns: list[str]) -> list[pa.Array]:
    """These columns of a block file."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(file)
    table = pq.read_table(path, filesystem=system, columns=columns,
                          partitioning=None).combine_chunks()
    return [_one(table, name) for name in columns]


def read_block(file: str) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(keys, ids, matrix) of a block file."""
    if file not in _last:
        keys, ids, vecs = read_columns(file, ["key", "id", "vec"])
        _last.clear()
        _last[file] = (keys.to_numpy(zero_copy_only=False), ids, matrix_of(vecs))
    return _last[file]


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if queries.shape[1] != vectors.shape[1]:
        raise ValueError("vectors of unequal size")
    return queries @ vectors.T


def _first_k(q: np.ndarray, row: np.ndarray, score: np.ndarray, order: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (score, then ``order``) of each query."""
    by = np.lexsort((order[row], -score, q))
    q, row, score = q[by], row[by], score[by]
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else q
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    keep = place < k
    return q[keep], row[keep], score[keep]


def best_pairs(queries: np.ndarray, vectors: np.ndarray, order: np.ndarray, k: int,
               allowed: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the k best vectors of each query; scores at 6 places, ties by
    ``order``. The products are made in tiles of a few million numbers, in single precision where
    that can be told to be near enough; only those near a query's k-th best so far are made
    again in double precision, rounded and sorted. ``allowed(a, b)`` is a mask (queries,
    vectors a to b) of the pairs that count; the queries are one tile then."""
    out = []
    # the error of a product is at most its length's number of roundings, by Cauchy and Schwarz
    size = [float(np.sqrt(np.einsum("ij,ij->i", m, m).max(initial=0))) for m in (queries, vectors)]
    slack = (vectors.shape[1] + 4) * SINGLE * size[0] * size[1] + 1e-30
    single = np.isfinite(slack) and slack < 1e-3 and max(size) < 1e15
    if not single:
        slack = 0.0
    fast = vectors.astype(np.float32) if single else vectors
    for qa in range(0, len(queries), TILE_QUERIES):
        some = queries[qa:qa + TILE_QUERIES]
        quick = some.astype(np.float32) if single else some
        floor = np.full(len(some), -np.inf)            # each query's k-th best so far
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for va in range(0, len(vectors), TILE_VECTORS):
            score = products(quick, fast[va:va + TILE_VECTORS])
            width = score.shape[1]
            if allowed is not None:
                score[~allowed(va, va + width)] = -np.inf
            least = floor - (ROUNDING + 2 * slack)
            # most queries have nothing near their best in a tile; NaN is near
            hot = np.flatnonzero(~(score.max(axis=1) < least))
            if not len(hot):
                continue
            if len(hot) < len(some):
                score, least = score[hot], least[hot]
            near = score >= least[:, None].astype(score.dtype)
            if width > k and np.count_nonzero(near) > CROWD * k * len(hot):
                cut = np.partition(score, width - k, axis=1)[:, width - k].astype(np.float64)
                least = np.maximum(least, cut - (ROUNDING + 2 * slack))
                near = score >= least[:, None].astype(score.dtype)
            q, row = np.nonzero(near)
            if allowed is not None:
                known = score[q, row] > -np.inf
                q, row = q[known], row[known]
            if not single:
                found = score[q, row]
            elif len(q) > score.size // PAIRS_SHARE:
                found = products(some[hot], vectors[va:va + width])[q, row]
            q = hot[q]
            if single and len(q) <= score.size // PAIRS_SHARE:
                found = np.concatenate([np.zeros(0), *(
                    np.einsum("ij,ij->i", some[q[at:at + PAIRS]], vectors[va + row[at:at + PAIRS]])
                    for at in range(0, len(q), PAIRS))])
            held = _first_k(*(np.concatenate(x) for x in zip(held, (q, row + va, np.round(found, 6)))),
                            order, k)
            full = np.flatnonzero(np.bincount(held[0], minlength=len(some)) >= k)
            ends = np.searchsorted(held[0], full, side="right") - 1
            floor[full] = held[2][ends]
        out.append((held[0] + qa, held[1], held[2]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else held


def chunked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _one(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def topk_against(vectors: DataFrame, blocks: list[tuple], k: int, qid: str, schema: str,
                 id_col: str = "verse_id") -> DataFrame:
    """(qid, id, score): the k best vectors of each query within each chunk of ``vectors(key,
    id, vec)``, scored against the block rows of equal key."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, CHUNK_BYTES):
            keys = _one(table, "key").to_numpy(zero_copy_only=False)
            ids, matrix = _one(table, id_col), matrix_of(_one(table, "vec"))
            order = np.empty(len(ids), np.int64)
            order[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
            by = np.argsort(keys, kind="stable")
            mine, starts = np.unique(keys[by], return_index=True)
            rows_of = dict(zip(mine.tolist(), np.split(by, starts[1:])))
            for file, lo, hi in blocks:
                if lo is not None and (hi < mine[0] or lo > mine[-1]):
                    continue
                theirs, names, queries = read_block(file)
                at = np.searchsorted(theirs, mine, side="left")
                end = np.searchsorted(theirs, mine, side="right")
                for key, a, b in zip(mine.tolist(), at.tolist(), end.tolist()):
                    if a == b:
                        continue
                    rows = rows_of[key]
                    q, row, score = best_pairs(queries[a:b], matrix[rows], order[rows], k)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(q + a)), ids.take(pa.array(rows[row])),
                         pa.array(score)], names=[qid, id_col, "score"])

    return vectors.mapInArrow(per_task, schema)


def nearest(vectors: DataFrame, blocks: list[tuple], vec_col: str, out: str) -> DataFrame:
    """``vectors`` with ``out``, the id of the block row of the highest product (ties: the
    lower id); null for a null vector."""
    schema = T.StructType([*vectors.schema.fields, T.StructField(out, T.LongType())])
    columns = vectors.columns

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, CHUNK_BYTES):
            vecs = _one(table, vec_col)
            known = np.flatnonzero(vecs.is_valid().to_numpy(zero_copy_only=False))
            matrix = matrix_of(vecs.take(pa.array(known)))
            best, name = np.full(len(known), -np.inf), np.full(len(known), -1, np.int64)
            for file, _, _ in blocks:
                _, ids, cells = read_block(file)
                ids = ids.to_numpy(zero_copy_only=False)
                if not len(ids):
                    continue
                by = np.argsort(ids, kind="stable")
                ids, cells = ids[by], cells[by]
                for at in range(0, len(known), TILE_VECTORS):
                    score = products(matrix[at:at + TILE_VECTORS], cells)
                    top = score.argmax(axis=1)
                    score, top = score[np.arange(len(top)), top], ids[top]
                    so_far, names = best[at:at + TILE_VECTORS], name[at:at + TILE_VECTORS]
                    wins = (score > so_far) | ((score == so_far) & (top < names))
                    so_far[wins], names[wins] = score[wins], top[wins]
            cell = np.full(table.num_rows, -1, np.int64)
            cell[known] = name
            cells_out = pa.array(cell, pa.int64(), mask=cell < 0)
            for at in range(0, table.num_rows, 8192):
                part = table.slice(at, 8192).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [*(_one(part, c) for c in columns), cells_out.slice(at, 8192)],
                    names=[*columns, out])

    return vectors.mapInArrow(per_task, schema)


def mapped(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` by chunks: ``fn(table)`` yields record batches."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, CHUNK_BYTES):
            yield from fn(table)

    return df.mapInArrow(per_task, schema)
