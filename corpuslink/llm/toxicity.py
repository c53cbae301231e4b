"""Toxic passages by maximum-scoring segments of token log-odds.

* Weights: for each word the log-odds between toxic and other training documents under
  an informative Dirichlet prior, spread as the words of both classes together and as
  heavy as the smaller class (or ``prior`` words). A word counts once a document, so that
  a text repeating one word teaches it once. Words whose weight exceeds ``min_z`` standard
  errors are kept, at most ``max_words`` of them; all other words share one pooled weight,
  made negative. The bar is low, so that passages of many rarer words add up to a height;
  words below it are mostly chance (README).
* Passages: a linear scan (all maximal scoring segments) over the words of the whole
  text. Between two kept words the pooled weight just adds up.
* Calibration: with p the other documents' word frequencies, lambda solves
  sum p exp(lambda weight) = 1, and lambda * best - ln(words) follows an extreme-value
  law in clean text; a logistic curve over it, fitted to counts per bin of the training
  documents, gives the score. A passage is significant if n exp(-lambda S) is below
  ``alpha``.

The labelled sample is bounded: ``max_train`` documents in the order of a hash of their
id, a documented parameter. Words: runs of ASCII letters and digits and of all non-ASCII
characters, A-Z in lower case. A null or empty text has no passage and the least score.
Unlabelled or null-labelled rows teach nothing; without both classes every score is 0.
Repeated rows are scored alike; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a word: digits, lower-case letters and all bytes of non-ASCII characters.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
BINS = 400
LOW, HIGH = -30.0, 70.0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    other: float = -0.05
    rate: float = 1.0                   # lambda
    curve: tuple[float, float] = (-50.0, 0.0)


def maximal_segments(hits: list[int], weights: list[float], other: float
                     ) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text in which only the words
    at ``hits`` have positive weight and every other word weighs ``other``."""
    # a segment: first, last, sum before it, sum up to its end
    found: list[tuple[int, int, float, float]] = []
    total, at = 0.0, -1
    for i, w in zip(hits, weights):
        total += other * (i - at - 1)
        new = (i, i, total, total + w)
        total += w
        at = i
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                found.append(new)
                break
            new = (found[k][0], new[1], found[k][2], new[3])
            del found[k:]
    return [(a, b, r - l) for a, b, l, r in found]


def statistic(rate: float, best: float, words: int) -> float:
    """The calibrated height of a text's best passage."""
    if best <= 0:
        return LOW
    return min(max(rate * best - math.log(words), LOW), HIGH - 1e-9)


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, y1, y0): toxic and other documents of (_text, _y) that hold the word."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, y in zip(*(c.to_pylist() for c in batch.columns)):
                counts[y].update(set(words_of(text)))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(words, pa.binary()), pa.array([counts[1][w] for w in words], pa.int64()),
                pa.array([counts[0][w] for w in words], pa.int64())], names=["word", "y1", "y0"])

    return labelled.select("_text", "_y").mapInArrow(run, "word binary, y1 long, y0 long").groupBy(
        "word").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def score_rows(docs: DataFrame, model: Model, keep: list[str], alpha: float) -> DataFrame:
    """``keep`` columns, words, height and passages of every text in ``_text``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = held.value
        known = model.weights
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                n, heights, passages = [], [], []
                for text in part.column(0).to_pylist():
                    words = words_of(text)
                    hits = [i for i, w in enumerate(words) if w in known]
                    found = maximal_segments(hits, [known[words[i]] for i in hits], model.other)
                    best = max((s for _, _, s in found), default=0.0)
                    n.append(len(words))
                    heights.append(statistic(model.rate, best, len(words)))
                    passages.append([
                        {"first_word": a, "last_word": b, "weight": s} for a, b, s in found
                        if len(words) * math.exp(-model.rate * s) <= alpha])
                yield pa.RecordBatch.from_arrays([
                    *part.columns[1:], pa.array(n, pa.int64()), pa.array(heights, pa.float64()),
                    pa.array(passages, pa.list_(pa.struct([
                        ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("weight", pa.float64())])))],
                    names=[*part.schema.names[1:], "n_words", "height", "passages"])

    rows = docs.select("_text", *keep)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, fields + "n_words long, height double, passages array<struct<"
                                         "first_word:long,last_word:long,weight:double>>")


def _rate(p: np.ndarray, w: np.ndarray) -> float:
    """lambda with sum p exp(lambda w) = 1, by bisection."""
    low, high = 1e-6, 1.0
    while (p * np.exp(np.minimum(high * w, 700))).sum() < 1 and high < 1e3:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        if (p * np.exp(np.minimum(mid * w, 700))).sum() < 1:
            low = mid
        else:
            high = mid
    return low


def _curve(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Logistic intercept and slope from counts per bin, with a slight ridge (Newton)."""
    a, b, ridge = 0.0, 0.0, 1e-2
    scale = 10.0
    z = x / scale
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -500, 500)))
        n = ones + zeros
        g = np.array([(ones - n * p).sum() - ridge * a, ((ones - n * p) * z).sum() - ridge * b])
        v = n * p * (1 - p)
        h = np.array([[v.sum() + ridge, (v * z).sum()], [(v * z).sum(), (v * z * z).sum() + ridge]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0) / scale)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_train: int = 40_000, prior: float | None = None,
          min_z: float = 2.5, max_words: int = 50_000, alpha: float = 0.01) -> Model:
    """Learn from the rows of ``labels`` (id, 0/1) that ``docs`` has."""
    spark = docs.sparkSession
    sample = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).orderBy(
        F.xxhash64(F.col("_id").cast("string")), "_y").limit(max_train)
    sample = sample.groupBy("_id").agg(F.max("_y").alias("_y"))
    # the sample's bound (max_train rows of 12 bytes) is the bound of the broadcast
    texts = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    labelled = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_text", "_y")
    from corpuslink.llm.scratch import written
    counts = written(word_counts(labelled), "word-counts")
    n1, n0 = counts.agg(F.sum("y1"), F.sum("y0")).first()
    if not n1 or not n0:
        return Model()
    prior = prior or float(min(n1, n0))
    a = F.lit(prior) * (F.col("y1") + F.col("y0")) / F.lit(float(n1 + n0))
    odds = lambda y, n: F.log((F.col(y) + a) / (F.lit(n + prior) - F.col(y) - a))
    weight = odds("y1", n1) - odds("y0", n0)
    z = weight / F.sqrt(1 / (F.col("y1") + a) + 1 / (F.col("y0") + a))
    kept = counts.withColumns({"weight": weight, "z": z}).where(F.col("z") >= min_z).orderBy(
        F.col("z").desc(), "word").limit(max_words).collect()
    weights = {bytes(r["word"]): float(r["weight"]) for r in kept}
    rest1 = n1 - sum(r["y1"] for r in kept)
    rest0 = n0 - sum(r["y0"] for r in kept)
    other = min(math.log((rest1 + 1) / (n1 + prior)) - math.log((rest0 + 1) / (n0 + prior)), -0.05)
    p = np.array([(r["y0"] + 0.5) / n0 for r in kept] + [rest0 / n0])
    model = Model(weights, other, _rate(p / p.sum(), np.array([*weights.values(), other])))
    heights = score_rows(labelled, model, ["_y"], alpha)
    bins = heights.groupBy("_y", F.floor((F.col("height") - LOW) / ((HIGH - LOW) / BINS)).alias(
        "bin")).count().collect()                             # two classes of BINS bins
    ones, zeros = np.zeros(BINS), np.zeros(BINS)
    for y, b, n in bins:
        (ones if y else zeros)[int(b)] += n
    x = LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS
    model.curve = _curve(x, ones, zeros)
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          keep: dict[str, Column] | None = None, alpha: float = 0.01) -> DataFrame:
    """(id_col, kept columns, n_words, height, passages, score) of every row."""
    keep = keep or {}
    rows = score_rows(docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias(id_col),
                                  *(c.alias(k) for k, c in keep.items())),
                      model, [id_col, *keep], alpha)
    a, b = model.curve
    return rows.withColumn("score", 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("height")))))
