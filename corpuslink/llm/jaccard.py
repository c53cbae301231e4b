"""Exact n-gram Jaccard join by PartEnum signatures, and its connected classes.

A document's set is its distinct word shingles (``shingles``). With a similarity of
``P / Q`` (0.8) two sets of a and b elements, a <= b <= a Q / P, differ in at most
(a + b) (Q - P) / (Q + P) elements.

* Bands: sizes fall into bands [lo, lo Q / P]. Scheme j serves the pairs whose smaller set
  lies in band j, so a set takes part in the schemes of its own band and of the one below.
* Signatures: scheme j deals the feature domain (by hash) to n = k + 1 + m parts, k the
  most elements in which a pair of the scheme can differ. Each differing element spoils
  one part at most, so at least n - k parts agree; each part's content makes a signature.
  Empty parts make none. A pair could thus be lost only if n - k or more parts are empty
  in both its sets: such sparse sets also take part in the scheme dealt anew with another
  salt, up to ``SALTS`` times, and then with every single element. So no pair is lost.
* Sets that are equal (64-bit hash of the set) make one class before any comparison.
* Candidates: the members of a signature meet its hub, the member that meets most sets (a
  star, linear in the members). Histograms of the sets turn most away (their distance
  never exceeds the sets' difference), an exact intersection decides. Where members of a signature are then
  still in different classes, all such pairs are compared by their histograms in blocks
  of ``BLOCK`` members, and the close ones again exactly. Classes grow by links alone.

Rows: a null id keeps a null class id of its own unless its set has others. Without words
the set is empty and links with nothing. Rows that repeat an id are members like others.
Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuslink.llm.components import components
from corpuslink.llm.scratch import written
from corpuslink.llm.shingles import mix, shingle_sets
from corpuslink.llm.tokens import release, slices

P, Q = 4, 5                     # similarity 0.8
SALTS = 8
BLOCK = 2048
BUCKETS = 128
FINE = 512                       # buckets of the second histogram
SLICE_BYTES = 4 << 20
MAX_BROADCAST_NODES = 1_000_000   # 8 MB of ids


def band_starts(top: int) -> np.ndarray:
    """The least size of each band, up to one beyond ``top``."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * Q // P + 1)
    return np.array(out)


def parts_of(band: int, starts: np.ndarray) -> tuple[int, int]:
    """(k, n) of a scheme: the most differing elements and the number of parts."""
    high = int(starts[band]) * Q // P
    k = (high + high * Q // P) * (Q - P) // (Q + P)
    return k, k + 2 + k // 10


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All signatures of one set of distinct hashes."""
    own = int(np.searchsorted(starts, len(values), "right")) - 1
    out = []
    for band in (own, own - 1):
        if band < 0:
            continue
        k, n = parts_of(band, starts)
        if k == 0:
            continue                                    # only equal sets are that near
        for salt in range(SALTS + 1):
            tag = np.uint64(((band * (SALTS + 1)) + salt + 1) << 20)
            if salt == SALTS:
                out.append(mix(values ^ mix(tag)))
                break
            part = ((mix(values + tag) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
                    ).astype(np.int64)
            order = np.argsort(part, kind="stable")
            size = np.bincount(part, minlength=n)
            full = np.flatnonzero(size)
            sums = np.add.reduceat(values[order], (np.cumsum(size) - size)[full])
            out.append(mix(sums ^ mix(tag + full.astype(np.uint64))))
            if n - len(full) < n - k:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list, np.ndarray]]:
    """(first row, rows, sets, set hashes) of the texts of a batch, slice by slice."""
    for at, rows in slices(batch.column(column), SLICE_BYTES):
        values, sizes = shingle_sets(batch.column(column).slice(at, rows))
        ends = np.cumsum(sizes)
        hashes = np.zeros(rows, np.uint64)
        has = np.flatnonzero(sizes)
        if len(has):
            hashes[has] = mix(np.add.reduceat(mix(values), (ends - sizes)[has])
                              + sizes[has].astype(np.uint64))
        yield at, rows, np.split(values, ends[:-1]), hashes


def _hist(elements: np.ndarray, buckets: int) -> bytes:
    """How many elements fall into each bucket, up to 255."""
    found = np.bincount((elements % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def set_table(docs: DataFrame) -> DataFrame:
    """(doc_id, _hash, n, h, hist, fine) of (doc_id, _hash, text): set size, set hash (null: empty
    set) and two histograms of the elements."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, sets, hashes in _sets(batch, 2):
                size = np.array([len(s) for s in sets])
                hists = [pa.array([_hist(s, b) for s in sets], pa.binary()) for b in (BUCKETS, FINE)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, rows), batch.column(1).slice(at, rows),
                    pa.array(size, pa.int64()), pa.array(hashes.view(np.int64), mask=size == 0),
                    *hists], names=["doc_id", "_hash", "n", "h", "hist", "fine"])
        release()

    return docs.mapInArrow(
        run, "doc_id long, _hash long, n long, h long, hist binary, fine binary")


def signature_rows(docs: DataFrame) -> DataFrame:
    """(sig, h): every signature of every set, equal sets once a task."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        starts = band_starts(1 << 16)
        for batch in batches:
            for _, _, sets, hashes in _sets(batch, 0):
                found, owner = [], []
                for s, h in zip(sets, hashes.view(np.int64).tolist()):
                    if not len(s) or h in seen:
                        continue
                    seen.add(h)
                    if len(s) > starts[-2]:
                        starts = band_starts(2 * len(s))
                    found.append(signatures(s, starts))
                    owner.append(h)
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.repeat(np.array(owner, np.int64), [len(f) for f in found]))],
                        names=["sig", "h"])
        release()

    return docs.select("text").mapInArrow(run, "sig long, h long")


def shared_signatures(rows: DataFrame) -> DataFrame:
    """(sig, h, place, m) of the signatures that m >= 2 different sets have; places count
    from 1."""
    once = rows.repartition("sig").dropDuplicates(["sig", "h"])
    own = Window.partitionBy("sig")
    return once.select("sig", "h", F.row_number().over(own.orderBy("h")).alias("place"),
                       F.count(F.lit(1)).over(own).alias("m")).where("m > 1")


def with_hubs(members: DataFrame) -> DataFrame:
    """(sig, h, place, m, hub): the member of each signature that meets most sets over all
    its signatures. In a group of near copies that is the one most like the others."""
    weight = members.groupBy("h").agg(F.sum("m").alias("w"))
    top = F.max(F.struct("w", "h")).over(Window.partitionBy("sig"))
    return members.join(weight, "h").select("sig", "h", "place", "m", top["h"].alias("hub"))


def _near(a: np.ndarray, b: np.ndarray, na, nb) -> np.ndarray:
    """May sets of these sizes and histograms be linked? (no for sure, or perhaps)"""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(-1, dtype=np.int64)
    return ((Q + P) * apart <= (Q - P) * (na + nb)) & (P * np.maximum(na, nb)
                                                       <= Q * np.minimum(na, nb))


def near_pairs(pairs: DataFrame, hists: DataFrame, buckets: int) -> DataFrame:
    """The pairs (a, b) of set hashes whose histograms do not rule a link out."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(
                -1, buckets) for c in (2, 3))
            keep = pa.array(_near(one, two, batch.column(4).to_numpy(), batch.column(5).to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1)],
                                             names=["a", "b"])

    side = lambda x: hists.select(F.col("h").alias(x), F.col("hist").alias(f"h{x}"),
                                  F.col("n").alias(f"n{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "ha", "hb", "na", "nb").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of set hashes that are linked, by exact intersection."""
    nodes = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct().join(
        classes, "h").select("h", F.col("first_id").alias("_id"))
    nodes = written(nodes, "nodes")
    few = nodes.count() <= MAX_BROADCAST_NODES
    texts = docs.join(F.broadcast(nodes) if few else nodes, docs["doc_id"].eqNullSafe(nodes["_id"])
                      ).select("h", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, sets, hashes in _sets(batch, 1):
                own = batch.column(0).slice(at, rows).to_numpy()
                keep = np.flatnonzero(own == hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(own[keep]), pa.array([len(sets[i]) for i in keep], pa.int64()),
                    pa.array([_hist(sets[i], FINE) for i in keep], pa.binary()),
                    pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64()))],
                    names=["h", "n", "hist", "elements"])

    sets = written(texts.mapInArrow(run, "h long, n long, hist binary, elements array<long>")
                   .dropDuplicates(["h"]), "sets")
    pairs = written(near_pairs(pairs, sets.select("h", "n", "hist"), FINE), "pairs")
    # A pair travels with the elements of a alone; b, the hub, has few different values.
    hubs = pairs.select(F.col("b").alias("h")).distinct()
    hubs = F.broadcast(hubs) if hubs.count() <= MAX_BROADCAST_NODES else hubs
    side = lambda df, x: df.select(F.col("h").alias(x), F.col("elements").alias(f"e{x}"))
    both = F.size(F.array_intersect("ea", "eb"))
    return pairs.join(side(sets, "a"), "a").join(
        side(sets.join(hubs, "h", "left_semi"), "b"), "b").withColumn("_both", both).where(
        Q * F.col("_both") >= P * (F.size("ea") + F.size("eb") - F.col("_both"))).select("a", "b")


def block_pairs(members: DataFrame, hists: DataFrame) -> DataFrame:
    """Pairs within a signature whose members are in different classes and near by their
    histograms, from (sig, h, place, m, c) and (h, n, fine). A signature's members are compared
    block by block, by the fine histograms folded to ``BUCKETS`` first, then as they are."""
    rows = members.join(hists, "h").withColumn(
        "_block", F.floor((F.col("place") - 1) / BLOCK).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / BLOCK).cast("int")))
    rows = rows.select("*", each.alias("_other")).select(
        "sig", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"),
        "h", "c", "n", "fine", (F.col("_block") == F.least("_block", "_other")).alias("_one"),
        (F.col("_block") == F.greatest("_block", "_other")).alias("_two"))
    key = ["sig", "_i", "_j"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *key).sortWithinPartitions(*key)

    def compare(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, c, n = (np.array([r[k] for r in held], np.int64) for k in (3, 4, 5))
        fine = np.frombuffer(b"".join(r[6] for r in held), np.uint8).reshape(-1, FINE)
        hist = fine.reshape(-1, FINE // BUCKETS, BUCKETS).sum(1, dtype=np.int16)
        one, two = (np.array([r[k] for r in held]) for k in (7, 8))
        right = np.flatnonzero(two)
        for i in np.flatnonzero(one):
            to = right[(c[right] != c[i]) & (h[right] != h[i])]
            if held[0][1] == held[0][2]:
                to = to[to > i]
            to = to[_near(hist[i], hist[to], n[i], n[to])]
            to = to[_near(fine[i], fine[to], n[i], n[to])]
            if len(to):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.minimum(h[i], h[to])), pa.array(np.maximum(h[i], h[to]))],
                    names=["a", "b"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    if len(held) > 1:
                        yield from compare(held)
                    held = []
                held.append(row)
        if len(held) > 1:
            yield from compare(held)

    return rows.mapInArrow(run, "a long, b long").distinct()


def link_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
                 ) -> DataFrame:
    """(doc_id, _hash, n_shingles, component_id, _class) of every row: its text's hash, the
    size of its set, the least id that links reach, and its class (null: empty set)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("text"))
    table = written(set_table(docs), "sets")
    classes = written(table.where(F.col("h").isNotNull()).groupBy("h").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"),
        F.first("hist").alias("hist"), F.first("fine").alias("fine")), "classes")
    hists = classes.select("h", "n", "hist")
    members = written(shared_signatures(signature_rows(docs)), "members")
    members = written(with_hubs(members), "hubs")

    star = members.where("h <> hub").select(F.col("h").alias("a"), F.col("hub").alias("b")).distinct()
    star = written(near_pairs(star, hists, BUCKETS), "star")
    links = written(linked(star, docs, classes), "links")
    joined = components(links)

    # signatures whose members are still in different classes; the star has met its pairs
    own = Window.partitionBy("sig")
    rest = members.where("m > 2").join(joined, members["h"] == joined["node"], "left").select(
        "sig", "h", "place", "m", "hub", F.coalesce("component", "h").alias("c")).withColumns(
        {"_lo": F.min("c").over(own), "_hi": F.max("c").over(own)}).where(
        "_lo <> _hi and h <> hub").drop("_lo", "_hi", "hub")
    met = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(block_pairs(rest, classes.select("h", "n", "fine")).join(met, ["a", "b"], "left_anti"), "pairs")
    links = links.union(linked(pairs, docs, classes))
    joined = written(components(links), "components")

    of = classes.join(joined, classes["h"] == joined["node"], "left").select(
        classes["h"], "first_id", F.coalesce("component", classes["h"]).alias("c"))
    least = of.groupBy("c").agg(F.min("first_id").alias("component_id"))
    of = of.join(least, "c").select("h", "component_id", F.col("c").alias("_class"))
    return table.join(of, "h", "left").select(
        "doc_id", "_hash", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "_class")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the least id (null ids last), and all
    rows with an empty set; equal rows of one id are one row."""
    rows = link_classes(docs, id_col=id_col, text_col=text_col)
    first = rows.where(F.col("_class").isNotNull()).groupBy("_class").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")).alias("f")).select(
        F.col("f")["doc_id"].alias("__llm_id"), F.col("f")["_hash"].alias("__llm_hash"))
    stay = first.union(rows.where(F.col("_class").isNull()).select("doc_id", "_hash").distinct())
    marked = docs.withColumn("__llm_own", F.xxhash64(text_col))
    return marked.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("__llm_id"))
                       & (F.col("__llm_own") == F.col("__llm_hash")), "left_semi"
                       ).dropDuplicates([id_col, "__llm_own"]).drop("__llm_own")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i + 1 : i + 5], ' ') END AS shingle
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
