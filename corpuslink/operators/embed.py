"""Embedding texts and encoders (O-08, O-61..O-63, O-66, O-92).

No model ships offline, so the default encoder is deterministic feature
hashing (tokens -> md5 -> slot and sign): a stand-in for a real sentence
encoder, not a semantic model. It and a real model plug in the same way,
``encode(..., encoder=factory)``: an iterator UDF (of pandas; of Arrow for the
default) that loads the model once per Python worker and encodes Arrow batches,
re-cut to ``batch`` texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.operators.query import UNIT_ORDER, top_n_per_key

# The three text strategies of the reference.
STRATEGIES = ("text_only", "book_context", "full_context")
DEFAULT_DIM = 384
DEFAULT_BATCH = 32


def embedding_texts(units: DataFrame, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """O-61: one row per (unit, strategy): text; "{ref} - {text}";
    "[{testament} Testament] {ref} - {text}"."""
    forms = {
        "text_only": F.col("text"),
        "book_context": F.concat(F.col("reference"), F.lit(" - "), F.col("text")),
        "full_context": F.concat(F.lit("["), F.col("testament"), F.lit(" Testament] "),
                                 F.col("reference"), F.lit(" - "), F.col("text")),
    }
    items = F.array(*[F.struct(F.lit(s).alias("strategy"), forms[s].alias("etext"))
                      for s in strategies])
    keep = [c for c in ("verse_id", *UNIT_ORDER) if c in units.columns]
    return units.select(*keep, F.inline(items)).withColumnRenamed("etext", "text")


def sample_texts(texts: DataFrame, n: int = 5) -> DataFrame:
    """O-08: the first ``n`` texts of every strategy in corpus order."""
    order = [F.col(c) for c in UNIT_ORDER if c in texts.columns] + [F.col("verse_id")]
    return top_n_per_key(texts, ["strategy"], order, n)


def hashing_model(dim: int = DEFAULT_DIM, remember: int = 500_000):
    """O-62 default encoder: signed feature hashing of lower-cased runs of letters and
    digits. A token's slot is the number of its md5's first 8 hexadecimal digits modulo
    ``dim``, its sign plus where the ninth is even. Tokens are hashed once a worker (up
    to a bound that changes the speed only); a batch is one weighted count."""
    token = re.compile(r"[^\W_]+")

    def factory():
        class Codes(dict):
            def __missing__(self, t: str) -> int:
                h = hashlib.md5(t.encode()).hexdigest()
                self[t] = 2 * (int(h[:8], 16) % dim) + (int(h[8], 16) % 2 == 0)
                return self[t]

        known = Codes()

        def run(texts):
            if len(known) > remember:
                known.clear()
            sizes, codes = [], []
            for text in texts:
                found = token.findall(text.lower())
                codes += map(known.__getitem__, found)
                sizes.append(len(found))
            codes = np.array(codes, np.int64)
            at = np.repeat(np.arange(len(texts)), sizes) * dim + codes // 2
            return np.bincount(at, np.where(codes % 2 == 1, 1.0, -1.0),
                               len(texts) * dim).reshape(len(texts), dim)
        return run
    return factory


def _unit_vectors(model: Callable, texts: list[str], dim: int, batch: int) -> np.ndarray:
    """The model's vectors of the texts, ``batch`` at a time, made of length one."""
    out = [np.zeros((0, dim), np.float32)]
    for k in range(0, len(texts), batch):
        part = texts[k:k + batch]
        arr = np.asarray(model(part), dtype=np.float64).reshape(len(part), dim)
        norm = np.sqrt((arr * arr).sum(axis=1, keepdims=True))
        out.append((arr / np.where(norm == 0, 1.0, norm)).astype(np.float32))
    return np.concatenate(out)


def pandas_encoder(factory: Callable[[], Callable], dim: int, batch: int = DEFAULT_BATCH):
    """O-92: wrap a model factory as an iterator pandas UDF returning array<float>.

    ``factory()`` runs once per Python worker (model load); the returned
    callable maps a list of at most ``batch`` strings to an (n, dim) array.
    """
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in batches:
            yield pd.Series(list(_unit_vectors(model, s.fillna("").tolist(), dim, batch)))
    return _encode


def arrow_encoder(factory: Callable[[], Callable], dim: int, batch: int = DEFAULT_BATCH):
    """``pandas_encoder`` on Arrow arrays: the vectors of a batch go back as lists over one
    buffer, not as an object a number. For models that take less time than that."""
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def _encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for s in batches:
            texts = s.fill_null("").to_pylist()
            vecs = _unit_vectors(model, texts, dim, batch)
            yield pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * dim,
                                           pa.array(vecs.ravel()))
    return _encode


def encode(texts: DataFrame, encoder: Callable | None = None, dim: int = DEFAULT_DIM,
           batch: int | None = None, text_col: str = "text") -> DataFrame:
    """O-62/O-63: normalised vectors for (verse_id, strategy, text) rows, long format.

    ``encoder`` is a model factory (default: ``hashing_model``); it is handed at most
    ``batch`` texts at a time, whatever the session's Arrow batches are.
    """
    if encoder is None:
        udf = arrow_encoder(hashing_model(dim), dim, batch or 512)
    else:
        udf = pandas_encoder(encoder, dim, batch or DEFAULT_BATCH)
    return texts.withColumn("vec", udf(F.col(text_col)))


def hash_encode(texts: DataFrame, dim: int = DEFAULT_DIM, text_col: str = "text",
                out: str = "vec") -> DataFrame:
    """``encode`` with the default encoder, into a column of any name."""
    return texts.withColumn(out, arrow_encoder(hashing_model(dim), dim, 512)(F.col(text_col)))


def embedding_run(vecs: DataFrame, model_name: str) -> DataFrame:
    """O-66: one row - model name, vector dimension (D1: from the vector, with a
    consistency flag), number of units, strategies."""
    return vecs.agg(
        F.lit(model_name).alias("model_name"),
        F.max(F.size("vec")).alias("embedding_dim"),
        (F.min(F.size("vec")) == F.max(F.size("vec"))).alias("dims_consistent"),
        F.countDistinct("verse_id").cast("long").alias("num_verses"),
        F.array_sort(F.collect_set("strategy")).alias("strategies"))


def letter_profile_model():
    """A tiny deterministic encoder for tests and demos: relative frequency of
    the letters a-z (26 dims). Stands in for a sentence model."""

    def run(texts):
        raw = [t.lower().encode("ascii", "ignore") for t in texts]
        b = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64) - 97
        doc = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        keep = (b >= 0) & (b < 26)
        out = np.bincount(doc[keep] * 26 + b[keep], minlength=26 * len(raw)).reshape(-1, 26)
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1)
    return run
