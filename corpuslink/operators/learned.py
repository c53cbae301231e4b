"""A text encoder learned from the corpus: the leading directions of its term matrix beside a
random projection of the weighted terms (O-62, O-92).

``fit`` weighs each text's words by (1 + ln tf) * ln(n / df), a row of length one, and finds the
``topics`` leading right singular vectors of all rows by randomised subspace iteration: a pass reads
the rows once, multiplies them by the current basis and sums what each task gives per word
(a partial aggregate of vectors in the JVM). A text's vector is its coordinates in those
directions, each divided by its singular value, scaled to ``topic_weight`` (what a text is about),
followed by a random projection of its row to the remaining dimensions, scaled to one (which words
it has). ``svd_model`` turns the fit into a factory for ``embed.encode``, like any other model.

Bounds, documented parameters of the model: the ``vocab`` words of most texts (ties: in the
words' order) that at least ``min_df`` texts hold have a row of their own; the others share
``RARE`` rows by hash. Only such rows, (``vocab`` + ``RARE``) x ``dim`` numbers, meet on the driver,
whatever the corpus. All texts count, whole. A text without words has the zero vector; so has a
null text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.grid import chunked
from corpuslink.session import written

TOKEN = re.compile(r"[^\W_]+")
VOCAB, RARE, OVERSAMPLE, ITERATIONS, SEED = 1 << 15, 1 << 13, 16, 3, 42
TILE_WORDS = 1 << 12         # so many rows of the basis stay in a core's cache
TEXT_BYTES = 8 << 20
REMEMBER = 500_000           # codes of other words that a task keeps, for speed only
TASKS_A_CORE = 4             # of a pass, each of which sends a row per word
BREAKS = {c: " " for c in range(128) if not TOKEN.fullmatch(chr(c))}


def _texts(table: pa.Table) -> list[str]:
    return [t or "" for t in table.column(0).to_pylist()]


def tokens(text: str) -> list[str]:
    """The lower-cased words, as ``TOKEN`` finds them."""
    low = text.lower()
    return low.translate(BREAKS).split() if low.isascii() else TOKEN.findall(low)


class Codes(dict):
    """The rows of words: their own, or one of ``rare`` by hash, kept once it is known."""

    def __init__(self, words: dict[str, int], rare: int):
        super().__init__(words)
        self.words, self.rare = words, rare

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.words) + REMEMBER:
            self.clear()
            self.update(self.words)
        self[word] = code = len(self.words) + zlib.crc32(word.encode()) % self.rare
        return code


def document_frequencies(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, df): in how many texts each word stands; a task sends a row per word and chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, TEXT_BYTES):
            seen: Counter[str] = Counter()
            for text in _texts(table):
                seen.update(set(tokens(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "df"])

    return texts.select(text_col).mapInArrow(run, "word string, df long").groupBy("word").agg(
        F.sum("df").alias("df"))


def weighted_rows(texts: list[str], words: dict[str, int], idf: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, words, weights) of the texts' rows, each row of length one."""
    codes = words if isinstance(words, Codes) else Codes(words, len(idf) - len(words))
    found, lengths = [], []
    for text in texts:
        some = tokens(text)
        lengths.append(len(some))
        found += map(codes.__getitem__, some)
    at = np.repeat(np.arange(len(texts)), np.array(lengths, np.int64)) * len(idf) + np.array(found, np.int64)
    at, counts = np.unique(at, return_counts=True)
    row, found = np.divmod(at, len(idf))
    weights = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt(np.bincount(row, weights * weights, len(texts)))
    return np.bincount(row, minlength=len(texts)), found, weights / np.where(norm == 0, 1, norm)[row]


def row_products(sizes: np.ndarray, found: np.ndarray, weights: np.ndarray,
                 basis: np.ndarray) -> np.ndarray:
    """The rows times ``basis``, in tiles of a bounded number of words."""
    out = np.zeros((len(sizes), basis.shape[1]))
    row = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(found), TILE_WORDS):
        r = row[at:at + TILE_WORDS]
        parts = basis[found[at:at + TILE_WORDS]]
        parts *= weights[at:at + TILE_WORDS, None]
        starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        out[r[starts]] += np.add.reduceat(parts, starts, axis=0)
    return out


def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """(A'A) basis for the rows A: one pass, summed per word before and after the shuffle."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    bc = rows.sparkSession.sparkContext.broadcast(basis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = bc.value
        total = np.zeros(basis.shape)
        touched = np.zeros(len(basis), bool)
        for batch in batches:
            words, weights = batch.column(0), batch.column(1)
            sizes = np.diff(words.offsets.to_numpy())
            found = words.flatten().to_numpy(zero_copy_only=False)
            weights = weights.flatten().to_numpy(zero_copy_only=False)
            projected = row_products(sizes, found, weights, basis)
            row = np.repeat(np.arange(len(sizes)), sizes)
            by = np.argsort(found, kind="stable")
            for at in range(0, len(by), TILE_WORDS):
                some = by[at:at + TILE_WORDS]
                w = found[some]
                parts = projected[row[some]]
                parts *= weights[some, None]
                starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                total[w[starts]] += np.add.reduceat(parts, starts, axis=0)
                touched[w[starts]] = True
        places = np.flatnonzero(touched)
        for at in range(0, len(places), 4096):
            part = total[places[at:at + 4096]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places[at:at + 4096]), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]),
                    pa.array(part.ravel()))], names=["word", "part"])

    spread = TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    sums = rows.coalesce(spread).mapInArrow(run, "word long, part array<double>").groupBy("word").agg(
        vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part"))
    out = np.zeros(basis.shape)
    for word, part in sums.collect():                     # at most ``vocab`` rows
        out[word] = part
    bc.unpersist()
    return out


def fit(texts: DataFrame, dim: int = 128, topics: int | None = None, topic_weight: float = 1.0,
        vocab: int = VOCAB, min_df: int = 2, iterations: int = ITERATIONS, text_col: str = "text"
        ) -> dict:
    """The model of ``texts(text)``: {'words': word -> row, 'idf', 'topics' (rows x topics, half
    of ``dim`` unless told), 'energy': their squared singular values, 'spread' (rows x rest),
    'topic_weight'}."""
    spark, topics = texts.sparkSession, dim // 2 if topics is None else topics
    top = document_frequencies(texts, text_col).where(F.col("df") >= min_df).orderBy(
        F.desc("df"), "word").limit(vocab).collect()
    n = max(texts.count(), min_df)
    words = {r.word: i for i, r in enumerate(top)}
    idf = np.log(n / np.array([r.df for r in top] + [1] * RARE, np.float64))
    bc = spark.sparkContext.broadcast((words, idf))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, idf = bc.value
        words = Codes(words, len(idf) - len(words))
        for table in chunked(batches, TEXT_BYTES):
            sizes, found, weights = weighted_rows(_texts(table), words, idf)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(found)),
                 pa.ListArray.from_arrays(ends, pa.array(weights))], names=["words", "weights"])

    rows = written(texts.select(text_col).mapInArrow(
        weigh, "words array<bigint>, weights array<double>"), "term-rows")
    draw = np.random.default_rng(SEED)
    basis = np.linalg.qr(draw.standard_normal((len(idf), topics + OVERSAMPLE)))[0]
    for _ in range(iterations):
        basis = np.linalg.qr(_gram_times(rows, basis))[0]
    small = basis.T @ _gram_times(rows, basis)
    energy, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-energy)[:topics]
    return {"words": words, "idf": idf, "topics": basis @ turn[:, order], "energy": energy[order],
            "spread": draw.choice([-1.0, 1.0], size=(len(idf), dim - topics)),
            "topic_weight": topic_weight}


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm == 0, 1, norm)


def svd_model(spark, model: dict):
    """The factory that ``embed.encode(encoder=..., dim=...)`` takes."""
    bc = spark.sparkContext.broadcast(model)

    def factory():
        m = bc.value
        # a direction that no text has stays out
        scale = np.where(m["energy"] > 1e-9, 1 / np.sqrt(np.maximum(m["energy"], 1e-9)), 0)
        words, n = Codes(m["words"], len(m["idf"]) - len(m["words"])), len(scale)
        basis = np.hstack([m["topics"] * scale, m["spread"]])

        def run(texts: list[str]) -> np.ndarray:
            out = row_products(*weighted_rows(texts, words, m["idf"]), basis)
            return np.hstack([m["topic_weight"] * _unit(out[:, :n]), _unit(out[:, n:])])
        return run
    return factory
