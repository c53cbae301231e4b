"""Packing token streams into fixed windows by order-preserving dynamic programming.

Each task walks its documents in stored order and joins their ids into one stream,
in segments of about ``segment_tokens`` (whole documents, so a segment holds one
document at least). Cuts may stand after a document (free), after a sentence
(``sentence_cost``) and, only inside sentences longer than ``long_sentence`` ids, at
every ``step`` ids (``inner_cost``); all costs are in padded ids. With f(c) the least
cost of packing the first c ids,

    f(c) = cost(c) + window - c + min over b in [c - window, c) of (f(b) + b)

and the minimum over the sliding range comes from a monotone queue, so a segment takes
time linear in its cut places. Nothing is shuffled: the result depends on a task's own
rows only, and a lost task is simply run again.

Nulls, empties: a null or empty text is the end id alone. A null id column value is
kept as null. Repeated rows are packed as often as they occur. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm import tokens as TK

#: Ids of sequence numbers within one task.
SEQUENCE_BITS = 36
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


def cut_places(ends: np.ndarray, doc_ends: np.ndarray, n: int, sentence_cost: int,
               inner_cost: int, long_sentence: int, step: int) -> tuple[list[int], list[int]]:
    """All cut places (0 and n included) with their costs. ``ends``: sentence ends."""
    places = np.unique(np.concatenate([[0], ends, doc_ends, [n]]))
    gaps = np.diff(places)
    extra = [np.arange(places[i] + step, places[i + 1], step)
             for i in np.flatnonzero(gaps > long_sentence)]
    cost = np.full(len(places), sentence_cost, np.int64)
    cost[np.searchsorted(places, np.concatenate([[0], doc_ends, [n]]))] = 0
    if extra:
        inner = np.concatenate(extra)
        order = np.argsort(np.concatenate([places, inner]), kind="stable")
        cost = np.concatenate([cost, np.full(len(inner), inner_cost, np.int64)])[order]
        places = np.concatenate([places, inner])[order]
    return places.tolist(), cost.tolist()


def best_cuts(places: list[int], cost: list[int], window: int) -> list[int]:
    """The cuts (first 0, last n) of least padding plus cost; gaps must be at most window."""
    n = len(places)
    least = [0] * n                  # f(b) + b
    back = [0] * n
    queue: deque[int] = deque([0])
    first = 0
    for i in range(1, n):
        c = places[i]
        while places[queue[0]] < c - window:
            queue.popleft()
        first = queue[0]
        back[i] = first
        g = cost[i] + window + least[first]      # f(c) + c
        least[i] = g
        while queue and least[queue[-1]] >= g:
            queue.pop()
        queue.append(i)
    cuts, i = [places[-1]], n - 1
    while i > 0:
        i = back[i]
        cuts.append(places[i])
    return cuts[::-1]


def sentence_ends(path: str, size: int) -> np.ndarray:
    """For each id: does its token end a sentence (full stop, !, ? or a line break)?"""
    vocab = TK.encoder(path).tokenizer.get_vocab()
    ends = np.zeros(size, bool)
    for token, i in vocab.items():
        word = token.replace("</w>", "")
        ends[i] = word.endswith((".", "!", "?", "Ċ"))
    return ends


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str = "byte_bpe_50k.json", end_id: int = 1, window: int = 2048,
                   segment_tokens: int = 1 << 20, sentence_cost: int = 4, inner_cost: int = 64,
                   long_sentence: int = 256, step: int = 64) -> DataFrame:
    """Pieces of all documents: which ids of a document lie where in which sequence.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit integers. Sequence
    numbers are unique; those of one task are consecutive.
    """
    if not 0 < step <= long_sentence <= window:
        raise ValueError("step, long_sentence and window must ascend")
    path = TK.tokenizer_path(tokenizer)

    def segments(batches) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """(document ids, sizes, all ids with their end ids) of each segment."""
        encode = TK.encoder(path).encode
        names: list = []
        lens: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        size = 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for at, rows in TK.slices(batch.column(1)):
                ids, sizes = encode(batch.column(1).slice(at, rows))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                names += own[at:at + rows]
                lens.append(sizes + 1)
                parts.append(ids)
                size += len(ids)
                if size >= segment_tokens:
                    yield names, np.concatenate(lens), np.concatenate(parts)
                    names, lens, parts, size = [], [], [], 0
        if names:
            yield names, np.concatenate(lens), np.concatenate(parts)

    def pack(batches):
        ends_sentence = None
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                            ("offset", pa.int64()), ("ids", pa.binary())])
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        for names, lens, ids in segments(batches):
            if ends_sentence is None:
                top = max(TK.encoder(path).tokenizer.get_vocab().values())
                ends_sentence = sentence_ends(path, max(top, end_id) + 1)
            doc_ends = np.cumsum(lens)
            doc_starts = doc_ends - lens
            n = len(ids)
            cuts = np.array(best_cuts(*cut_places(
                np.flatnonzero(ends_sentence[ids]) + 1, doc_ends, n, sentence_cost,
                inner_cost, long_sentence, step), window), np.int64)
            bounds = np.union1d(cuts, doc_starts)        # every piece starts at one of these
            at, to = bounds[:-1], bounds[1:]
            if len(bounds) and bounds[-1] != n:
                at, to = bounds, np.append(bounds[1:], n)
            doc = np.searchsorted(doc_starts, at, "right") - 1
            seq = np.searchsorted(cuts, at, "right") - 1
            name = pa.array(names, pa.int64()).take(pa.array(doc))
            offsets = pa.py_buffer((np.append(at, n) * 4).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([
                name, pa.array(at - doc_starts[doc]), pa.array(to - at), pa.array(lens[doc]),
                pa.array(sequence + seq), pa.array(at - cuts[seq]),
                pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(ids.tobytes())]),
            ], schema=schema)
            sequence += len(cuts) - 1
        TK.release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(pack, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
