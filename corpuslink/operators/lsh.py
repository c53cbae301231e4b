"""Approximate search by hyperplane signatures with multi-probe (O-67, ``method='lsh'``).

A table of signatures holds, for each of ``tables`` sets of ``bits`` hyperplanes, on which sides
a vector lies. A query probes its own bucket of every table and those reached by flipping the
sides it is least sure of: of all choices of at most ``MAX_FLIPS`` bits the ``probes`` with the
smallest sum of squared distances to the flipped planes. Candidates are the vectors of which some
table's code is probed; only they can be found.

The planes are a fixed rule, not a draw: sign vectors (rows of a Hadamard matrix with its columns
signed by a hash), so they are orthogonal where the dimension is a power of two and every engine
can rebuild them.

Scale: equal vectors are one row of the index (their ids join again at the end, k of them at
most), so a vector that a third of all rows share is one candidate, not a hot bucket. The number
of candidates is a share of all pairs, so pairs are never rows: the queries lie with their probes in
block files of a shared table, and a task holds a chunk of the vectors with their codes. For a tile
of queries it has, per table and code, a bit per query that probes it; a vector's candidates are
these bits, or-ed over the tables: a few words a table for a thousand queries. A tile is multiplied
as a whole and what is no candidate masked out, which costs less than gathering pairs. A task sends
k rows a query, and nothing passes the driver but the blocks' names.

Zero vectors have every side equal to "not above" and score 0; null vectors are not indexed and
null queries have no result. Ties go to the lower id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.functions.vectors import l2_normalize
from corpuslink.operators import grid
from corpuslink.operators.query import top_n_per_key
from corpuslink.session import written

BITS, TABLES, PROBES, MAX_FLIPS = 12, 24, 96, 4
BLOCK_QUERIES = 1 << 12


@lru_cache(maxsize=4)
def planes(dim: int, count: int) -> np.ndarray:
    """``count`` hyperplanes: plane p has the sign of Hadamard row p mod size, times the sign
    that md5 gives to (p div size, column)."""
    size = 1 << max(0, dim - 1).bit_length()
    columns = np.arange(dim)
    out = np.empty((count, dim))
    for r in range(-(-count // size)):
        signs = np.array([1 if int(hashlib.md5(f"{r}:{d}".encode()).hexdigest()[0], 16) < 8 else -1
                          for d in range(dim)])
        for i in range(min(size, count - r * size)):
            odd = np.array([int(x).bit_count() & 1 for x in (columns & i)])
            out[r * size + i] = signs * (1 - 2 * odd)
    return out


@lru_cache(maxsize=4)
def flips(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(masks, membership) of all choices of at most MAX_FLIPS of ``bits`` bits, by mask."""
    masks = sorted(sum(1 << b for b in chosen) for n in range(min(MAX_FLIPS, bits) + 1)
                   for chosen in combinations(range(bits), n))
    masks = np.array(masks, np.int64)
    return masks, (masks[:, None] >> np.arange(bits) & 1).astype(float)


def codes_of(matrix: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, distances): per vector and table the side code, and the signed distances."""
    far = (matrix @ planes(matrix.shape[1], bits * tables).T).reshape(len(matrix), tables, bits)
    return (far > 0) @ (1 << np.arange(bits, dtype=np.int64)), far


def probe_codes(matrix: np.ndarray, bits: int, tables: int, probes: int) -> np.ndarray:
    """The codes that each query probes, (queries, tables, probes)."""
    codes, far = codes_of(matrix, bits, tables)
    masks, member = flips(bits)
    probes = min(probes, len(masks))
    out = np.empty((len(matrix), tables, probes), np.int64)
    for at in range(0, len(matrix), 256):
        cost = np.round((far[at:at + 256] ** 2) @ member.T, 9)
        best = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]     # ties: the lower mask
        out[at:at + 256] = codes[at:at + 256, :, None] ^ masks[best]
    return out


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32)
                                             * values.shape[1]),
                                    pa.array(values.ravel().astype(np.int32)))


def _coded(df: DataFrame, id_col: str, out: str, fn: Callable) -> DataFrame:
    """``df(id, vec)`` with ``out``, the codes that ``fn(matrix)`` gives a vector, as one array."""
    schema = (f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, vec array<double>, "
              f"{out} array<int>")

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for at in range(0, table.num_rows, 4096):
            part = table.slice(at, 4096).combine_chunks()
            vecs = part.column("vec").chunk(0)
            codes = fn(grid.matrix_of(vecs))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col).chunk(0), vecs, _list(codes.reshape(len(codes), -1))],
                names=[id_col, "vec", out])

    return grid.mapped(df.select(id_col, "vec"), run, schema)


def build_lsh(vecs: DataFrame, bits: int = BITS, tables: int = TABLES) -> dict:
    """The index of ``vecs(verse_id, vec)``: 'vectors' (one id for all that are equal, with its
    code in each table), 'members' (those ids and all others of the same vector), 'signatures'
    (the codes as rows)."""
    unit = vecs.where(F.col("vec").isNotNull()).select(
        "verse_id", l2_normalize("vec").alias("vec"))
    single = unit.groupBy("vec").agg(F.min("verse_id").alias("verse_id"))
    vectors = written(_coded(single, "verse_id", "codes",
                             lambda m: codes_of(m, bits, tables)[0]), "lsh-vectors")
    members = written(unit.join(vectors.select(F.col("verse_id").alias("rep"), F.col(
        "vec").alias("same")), F.col("vec") == F.col("same")).select("rep", "verse_id"), "lsh-members")
    signatures = vectors.select("verse_id", F.posexplode("codes").alias("tbl", "code"))
    return {"vectors": vectors, "members": members, "bits": bits, "tables": tables,
            "signatures": signatures}


@lru_cache(maxsize=1)
def _asked(file: str, tables: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(ids, matrix, probes) of a block file; probes are (queries, tables, codes)."""
    ids, vecs, probes = grid.read_columns(file, ["id", "vec", "probes"])
    codes = probes.flatten().to_numpy(zero_copy_only=False)
    return ids, grid.matrix_of(vecs), codes.reshape(len(ids), tables, -1) if len(ids) else codes


def probers(probes: np.ndarray, seen: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Per table, a row of bits for each code in ``seen``: which of the queries probe it."""
    out = []
    for t, (known, _) in enumerate(seen):
        codes = probes[:, t]
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        q, p = np.nonzero(known[at] == codes)
        bits = np.zeros((len(known), len(probes)), bool)
        bits[at[q, p], q] = True
        out.append(np.packbits(bits, axis=1))
    return out


def _against(index: dict, queries: DataFrame, probes: int, qid: str, schema: str,
             emit: Callable) -> DataFrame:
    """What ``emit(names, block, ids, matrix, order, allowed)`` yields for every chunk of the
    vectors and tile of the queries; ``allowed(a, b)`` tells which of the vectors a to b are
    candidates of the tile's queries, as a matrix (queries, vectors)."""
    bits, tables = index["bits"], index["tables"]
    count = min(probes, len(flips(bits)[0]))
    asked = queries.where(F.col("qvec").isNotNull()).select(
        F.col(qid).alias("id"), l2_normalize("qvec").alias("vec")).dropDuplicates()
    coded = _coded(asked, "id", "probes", lambda m: probe_codes(m, bits, tables, count))
    files = [f for f, _, _ in grid.write_blocks(coded, BLOCK_QUERIES * 8 * grid.BLOCK_DIM)]

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, matrix = grid._one(table, "verse_id"), grid.matrix_of(grid._one(table, "vec"))
        codes = grid.matrix_of(grid._one(table, "codes")).astype(np.int64)
        order = np.empty(len(ids), np.int64)
        order[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        seen = [np.unique(codes[:, t], return_inverse=True) for t in range(tables)]
        for file in files:
            names, block, probed = _asked(file, tables)
            for qa in range(0, len(names), grid.TILE_QUERIES):
                some = slice(qa, qa + grid.TILE_QUERIES)
                rows = probers(probed[some], seen)
                width = len(probed[some])

                def allowed(a: int, b: int) -> np.ndarray:
                    hit = rows[0][seen[0][1][a:b]]
                    for bits_of, (_, place) in zip(rows[1:], seen[1:]):
                        hit |= bits_of[place[a:b]]
                    return np.ascontiguousarray(np.unpackbits(hit, axis=1, count=width).T).view(bool)

                yield from emit(names.slice(qa, width), block[some], ids, matrix, order, allowed)

    return grid.mapped(index["vectors"].where(F.col("verse_id").isNotNull()), run, schema)


def _schema(index: dict, queries: DataFrame, qid: str) -> str:
    return (f"`{qid}` {queries.schema[qid].dataType.simpleString()}, verse_id "
            f"{index['vectors'].schema['verse_id'].dataType.simpleString()}")


def candidates(index: dict, queries: DataFrame, probes: int = PROBES, qid: str = "qid"
               ) -> DataFrame:
    """(qid, verse_id): the vectors that share a probed bucket with a query. A share of all
    pairs comes out; ``hits`` counts them without."""
    def emit(names, block, ids, matrix, order, allowed):
        for at in range(0, len(ids), grid.TILE_VECTORS):
            q, row = np.nonzero(allowed(at, at + grid.TILE_VECTORS))
            for k in range(0, len(q), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(q[k:k + (1 << 16)])),
                     ids.take(pa.array(row[k:k + (1 << 16)] + at))], names=[qid, "verse_id"])

    return _against(index, queries, probes, qid, _schema(index, queries, qid), emit)


def hits(index: dict, queries: DataFrame, k: int, probes: int = PROBES, qid: str = "qid"
         ) -> DataFrame:
    """(qid, verse_id, score, scored): each task's k best candidates of every query; rows without
    a verse_id tell how many candidates were scored."""
    schema = _schema(index, queries, qid) + ", score double, scored bigint"

    def emit(names, block, ids, matrix, order, allowed):
        scored = 0

        def counted(a: int, b: int) -> np.ndarray:
            nonlocal scored
            mask = allowed(a, b)
            scored += int(np.count_nonzero(mask))
            return mask

        q, row, score = grid.best_pairs(block, matrix, order, k, counted)
        n = len(q)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([names.take(pa.array(q)), pa.nulls(1, names.type)]),
             pa.concat_arrays([ids.take(pa.array(row)), pa.nulls(1, ids.type)]),
             pa.array([*score, None], pa.float64()),
             pa.array([*[None] * n, scored], pa.int64())],
            names=[qid, "verse_id", "score", "scored"])

    return _against(index, queries, probes, qid, schema, emit)


def topk_lsh(index: dict, queries: DataFrame, k: int, probes: int = PROBES, qid: str = "qid",
             found: DataFrame | None = None) -> DataFrame:
    """O-67: (qid, rank, verse_id, score) of the k best candidates of every query.

    ``found`` takes the result of ``hits`` where it is at hand already.
    """
    best = [F.desc("score"), F.asc("verse_id")]
    found = (hits(index, queries, k, probes, qid) if found is None else found).where(
        F.col("verse_id").isNotNull())
    top = top_n_per_key(found.select(qid, "verse_id", "score"), [qid], best, k).drop(
        "rank").withColumnRenamed("verse_id", "rep")
    # copies of a vector: their k smallest ids can be among a query's best, no others
    copies = top_n_per_key(index["members"].join(top.select("rep").distinct(), "rep", "left_semi"),
                           ["rep"], [F.asc("verse_id")], k).drop("rank")
    return top_n_per_key(top.join(copies, "rep").drop("rep"), [qid], best, k).select(
        qid, "rank", "verse_id", "score")


def search_report(index: dict, vecs: DataFrame, queries: DataFrame, k: int = 10,
                  probes: int = PROBES, qid: str = "qid") -> DataFrame:
    """O-81 for LSH, one row: recall against exact search, and the share of (query, vector)
    pairs that were scored."""
    from corpuslink.operators.vector import recall_at_k, topk_exact
    found = written(hits(index, queries, k, probes, qid), "lsh-hits")
    n_q = queries.where(F.col("qvec").isNotNull()).agg(F.count(F.lit(1))).scalar()
    n_v = index["vectors"].agg(F.count(F.lit(1))).scalar()
    scored = found.agg(F.coalesce(F.sum("scored"), F.lit(0))).scalar()
    # all pairs are multiplied for the truth: the vectors are dealt out, whatever files they lie in
    exact = topk_exact(vecs.repartition("verse_id"), queries, k, qid)
    return recall_at_k(topk_lsh(index, queries, k, probes, qid, found), exact, qid).withColumn(
        "scored", scored / (n_q * n_v))
