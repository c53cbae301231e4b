"""Periodic runs of words in texts, found as maximal pairs in the tree of LCP intervals.

A run is a stretch of words with smallest period q and at least ``max(min_words, 4 q)`` words
that no neighbouring word extends. With q its period and n its length, the words at its start
and one period later agree on exactly n - q words and differ in the word to their left: a
maximal pair of distance q. Turned round, a maximal pair of distance q whose common part is
l >= 3 q words is such a stretch of l + q words; nothing is extended.

Method, for a slice of texts at a time:

1. The words of all texts become numbers that no two texts share. Prefix doubling sorts the
   suffixes (only those still tied are sorted again), and the class numbers of every length
   2^k, kept on the way, give the common prefix of neighbours in that order exactly.
2. Neighbours with fewer words in common than any run's l (five, for runs of six words or more)
   belong to no run. What lies between such cuts is walked bottom-up as a tree of LCP intervals.
3. An interval keeps the positions of its suffixes in order, each with the class of the word to
   its left. When a child joins, smaller into larger, each of its positions meets its two
   neighbours there; pairs of unlike left classes at most l / 3 apart are reported. Neighbours are
   enough: an occurrence between a run's start and one period on would give the run a
   smaller period (Fine and Wilf), so the pair of a run is adjacent when its interval forms. Pairs
   at a multiple of the period have the run's start and length and give way to the smallest.

A text of n words costs O(n log^2 n) time whatever it repeats; nothing is quadratic in the
copies of a phrase or a period. A text is one task's work: 4 bytes a word for every doubling
until its suffixes differ.

Defined results: words are separated by ASCII white space and compared as they are. A null text
has no words, no runs and an empty text; so has an empty one. Rows keep their own results,
repeated ids included. An empty table gives an empty one. Extra columns are not carried;
``keep`` names those that are to pass.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sqltext import crc32_sql

SLICE_WORDS = 1 << 18           # texts of about so many words are sorted together
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                 ("period", pa.int64())]))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of ``ids`` in order, and for k = 0, 1, .. the class of every position by
    its first 2^k symbols; a position whose class is its own keeps its number."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    starts = np.concatenate([[True], ids[order][1:] != ids[order][:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    at = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(starts, at, 0))
    levels, h = [rank.astype(np.int32)], 1
    tied = ~(starts & np.append(starts[1:], True))
    where = np.flatnonzero(tied)                        # places in ``order`` not alone yet
    while len(where):
        pos = order[where]
        after = pos + h
        then = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        key = rank[pos] * (n + 1) + then + 1
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[where] = pos
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[pos] = where[np.maximum.accumulate(np.where(starts, np.arange(len(pos)), 0))]
        h *= 2
        levels.append(rank.astype(np.int32))
        where = where[~(starts & np.append(starts[1:], True))]
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """Common symbols of each suffix with the one before it in order; 0 where fewer than the
    largest power of two not above ``least`` agree."""
    n = len(order)
    out = np.zeros(n, np.int64)
    floor = min(least.bit_length() - 1, len(levels) - 1)
    same = levels[floor][order[1:]] == levels[floor][order[:-1]]
    places = np.flatnonzero(same) + 1
    a, b = order[places - 1], order[places]
    length = np.zeros(len(places), np.int64)
    for k in reversed(range(len(levels))):
        level = levels[k]
        inside = np.maximum(a, b) + length < n
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        length += np.where(inside & (level[x] == level[y]), 1 << k, 0)
    out[places] = length
    return out


def _joined(big: list[int], small: list[int], common: int, left: list[int],
            found: list[tuple[int, int, int]]) -> list[int]:
    """Positions of two children of an interval of ``common`` symbols, in order; adds to
    ``found`` (start, length, distance) of the pairs between them that are runs."""
    if len(big) < len(small):
        big, small = small, big
    reach = common // 3
    for x in small:
        k = bisect_left(big, x)
        if k and x - big[k - 1] <= reach and left[big[k - 1]] != left[x]:
            found.append((big[k - 1], common + x - big[k - 1], x - big[k - 1]))
        if k < len(big) and big[k] - x <= reach and left[big[k]] != left[x]:
            found.append((x, common + big[k] - x, big[k] - x))
    if len(small) * 16 < len(big):
        for x in small:
            insort(big, x)
        return big
    big += small
    big.sort()
    return big


def maximal_pairs(order: np.ndarray, common: np.ndarray, left: np.ndarray,
                  least: int) -> list[tuple[int, int, int]]:
    """(start, length, distance) of the maximal pairs at most a third of their common part
    apart, from the intervals of ``least`` common symbols on."""
    found: list[tuple[int, int, int]] = []
    places = np.flatnonzero(common >= least)
    if not len(places):
        return found
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    firsts = places[np.concatenate([[0], cuts])] - 1
    lasts = places[np.concatenate([cuts - 1, [len(places) - 1]])]
    left = left.tolist()
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        at = order[first:last + 1].tolist()
        steps = common[first + 1:last + 1].tolist()
        child, open_intervals = [at[0]], []
        for position, step in zip(at[1:], steps):
            while open_intervals and open_intervals[-1][0] > step:
                value, held = open_intervals.pop()
                child = _joined(held, child, value, left, found)
            if open_intervals and open_intervals[-1][0] == step:
                held = open_intervals[-1][1]
                open_intervals[-1] = (step, _joined(held, child, step, left, found))
            else:
                open_intervals.append((step, child))
            child = [position]
        while open_intervals:
            value, held = open_intervals.pop()
            child = _joined(held, child, value, left, found)
    return found


def text_runs(texts: Sequence[Sequence[bytes]], min_words: int = 6) -> list[list[tuple]]:
    """The runs (start, length, period) of every list of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(int(base[-1]), np.int64)
    used = 0
    for words, a, b in zip(texts, base[:-1].tolist(), base[1:].tolist()):
        number: dict[bytes, int] = {}
        ids[a:b] = [number.setdefault(w, len(number)) for w in words]
        ids[a:b] += used
        used += len(number)
    out: list[list[tuple]] = [[] for _ in texts]
    if not len(ids):
        return out
    # what a run's start and one period later must have in common, over all periods
    least = min(max(min_words - q, 3 * q) for q in range(1, max(2, min_words)))
    order, levels = suffix_order(ids)
    left = np.concatenate([[-1], ids[:-1]])
    left[base[:-1][sizes > 0]] = -1
    shortest: dict[tuple[int, int], int] = {}
    for start, length, distance in maximal_pairs(
            order, common_prefixes(order, levels, least), left, least):
        if length < min_words:
            continue
        known = shortest.get((start, length))
        if known is None or distance < known:
            shortest[start, length] = distance
    pairs = sorted((s, q, n) for (s, n), q in shortest.items())
    if pairs:
        owner = np.searchsorted(base, [p[0] for p in pairs], side="right") - 1
        for (s, q, n), t in zip(pairs, owner.tolist()):
            out[t].append((s - int(base[t]), n, q))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def greatest(runs: Sequence[tuple[int, int, int]]) -> tuple | None:
    """The run of the greatest length by period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              min_words: int = 6, keep: dict[str, Column] | None = None,
              prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, greatest, collapsed) of every text, besides ``keep``.

    ``prepare(id, words)`` may rewrite a text's words (UTF-8) before the search.
    """
    kept = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                       *[c.alias(f"keep_{k}") for k, c in (keep or {}).items()])
    names = kept.columns[2:]
    out = ", ".join([f"_id {kept.schema['_id'].dataType.simpleString()}", "n_words bigint",
                     f"runs {RUNS}", "greatest struct<start:bigint,length:bigint,period:bigint>",
                     "collapsed string",
                     *[f"{n} {kept.schema[n].dataType.simpleString()}" for n in names]])

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
        """Rows of a batch, as many as hold about SLICE_WORDS words."""
        first, held, size = 0, [], 0
        ids = batch.column(0)
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py()
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            if prepare is not None:
                words = prepare(ids[k].as_py(), words)
            held.append(words)
            size += len(words)
            if size >= SLICE_WORDS:
                yield first, held
                first, held, size = k + 1, [], 0
        if held:
            yield first, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch):
                runs = text_runs(texts, min_words)
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs]
                              for rs in runs], RUNS_ARROW),
                    pa.array([r and dict(zip(("start", "length", "period"), r))
                              for r in map(greatest, runs)], RUNS_ARROW.value_type),
                    pa.array([collapsed(t, r) for t, r in zip(texts, runs)],
                             pa.binary()).cast(pa.string()),
                    *[part.column(2 + k) for k in range(len(names))],
                ], names=["_id", "n_words", "runs", "greatest", "collapsed", *names])

    found = kept.mapInArrow(run, out)
    return found.select(F.col("_id").alias(id_col), "n_words", "runs", "greatest", "collapsed",
                        *[F.col(n).alias(n.removeprefix("keep_")) for n in names])


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's texts: a tenth of them repeat a stretch from some word on."""
    import zlib
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = find_runs(docs, prepare=planted)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    top = F.col("greatest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"),
        top["length"].alias("length"), top["period"].alias("period"),
        F.expr("(1000 * greatest.length) div greatest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: Equal five-word windows of one text, by distance; stretches of them are the runs.
ORACLE_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce({crc32_sql('doc_id')}, 1) AS h,
         coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
planted AS (
  SELECT *, len(w) AS n, h // 10 AS g,
         CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts),
words AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(w[:a],
    list_transform(range(a, n), lambda i: w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1]))
    ELSE w END AS w FROM planted),
grams AS (
  SELECT rid, n, i, array_to_string(w[i + 1:i + 5], ' ') AS gram
  FROM (SELECT rid, n, w, unnest(range(0, n - 4)) AS i FROM words)),
pairs AS (
  SELECT a.rid, a.i, b.i - a.i AS q, a.i - row_number() OVER (
         PARTITION BY a.rid, b.i - a.i ORDER BY a.i) AS island
  FROM grams a JOIN grams b ON a.rid = b.rid AND a.gram = b.gram AND a.i < b.i
   AND 4 * (b.i - a.i) <= a.n),
islands AS (SELECT rid, q, min(i) AS start, count(*) + 4 + q AS length FROM pairs
            GROUP BY rid, q, island),
runs AS (SELECT rid, start, length, min(q) AS period FROM islands
         WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
best AS (SELECT rid, count(*) AS n_runs, first(struct_pack(s := start, l := length, p := period)
           ORDER BY length::DOUBLE / period DESC, start, period) AS top,
           sha256(string_agg(start || ',' || length || ',' || period || chr(10), ''
                  ORDER BY start, period)) AS digest FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT x.rid, string_agg(x.word, ' ' ORDER BY x.i) AS body
         FROM (SELECT rid, unnest(range(0, n)) AS i, unnest(w) AS word FROM words) x
         ANTI JOIN gone ON gone.rid = x.rid AND gone.i = x.i GROUP BY x.rid)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length,
       top.p AS period, 1000 * top.l // top.p AS exponent_milli,
       coalesce(digest, sha256('')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM words t LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""
