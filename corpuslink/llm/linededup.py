"""Reversible line deduplication: exact reference tables behind sharded cuckoo filters.

A line's key is its text without white space at both ends and with A-Z in lower case;
keys shorter than ``min_chars`` code points never drop. Keys held by ``min_docs`` or
more documents lose all their lines except in the largest document id that holds them.

* The *postings* (key, document) are the exact reference table. They are kept as
  signed batches (+1 insert, -1 delete), one folder per batch id, written whole; a
  repeated batch overwrites itself, and deleting a document cancels its insertion.
* Each key belongs to a shard, and shards grow in number with the keys. A shard's row
  carries a cuckoo filter of its repeated keys and their exact table (key, largest
  document), ``SHARD_KEYS`` keys at most. Filters take insertions and deletions.
* Lines meet their shard's row in one shuffle, salted by document so that a key with a
  third of all lines is spread over many tasks; each task streams its lines past one
  shard row at a time. The filter turns nearly all single lines away, and what it lets
  through is looked up in the exact table, so its false positives never drop a line.

Nulls, empties, ties: a null or empty text is one empty line. Rows whose document id is
null are kept whole and hold no key. Rows that repeat a document id count as one
document; each is rewritten by its own lines. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpuslink.llm.scratch import new_folder, written

SHARD_KEYS = 100_000
MIN_CHARS = 20
MIN_DOCS = 3
BLANK = b" \t\n\x0b\x0c\r"
LINES = "_doc long, _text_hash long, _pos int, _key binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class CuckooFilter:
    """Sixteen-bit fingerprints, four to a bucket, two buckets for a key; keys are
    64-bit integers. ``delete`` takes out only what was inserted."""

    SLOTS = 4

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.mask = np.uint64(buckets - 1)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter holding all keys, with room for about a fifth more."""
        buckets = 4
        while buckets * cls.SLOTS * 0.8 < len(keys):
            buckets *= 2
        while True:
            made = cls(buckets)
            if all(made.insert(k) for k in keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = _mix(np.asarray(keys, np.uint64))
        mark = ((h >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        one = h & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket, mark):
        return (bucket ^ _mix(np.asarray(mark, np.uint64))) & self.mask

    def insert(self, key) -> bool:
        mark, one, two = (x[0] for x in self._places(np.array([key], np.uint64)))
        for bucket in (one, two):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = two
        for turn in range(500):
            slot = turn % self.SLOTS
            mark, self.table[bucket, slot] = self.table[bucket, slot], mark
            bucket = self._other(bucket, np.array([mark]))[0]
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def delete(self, key) -> bool:
        mark, one, two = (x[0] for x in self._places(np.array([key], np.uint64)))
        for bucket in (one, two):
            held = np.flatnonzero(self.table[bucket] == mark)
            if len(held):
                self.table[bucket, held[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(1)

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        made = cls(len(raw) // (2 * cls.SLOTS))
        made.table = np.frombuffer(raw, "<u2").astype(np.uint16).reshape(-1, cls.SLOTS)
        return made


def _halves(keys: list[bytes]) -> np.ndarray:
    """The first half of each 16-byte key as an integer."""
    return np.frombuffer(b"".join(keys), "<u8")[::2]


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """(_doc, _text_hash, _pos, _key) of every line long enough to drop; the key is a
    128-bit hash of the normalised line."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows, pos, keys = [], [], []
                part = batch.slice(k, 256)
                for r, text in enumerate(part.column(2).to_pylist()):
                    for p, line in enumerate(text.encode().lower().split(b"\n")):
                        line = line.strip(BLANK)
                        if len(line) >= min_chars and (len(line) >= 4 * min_chars
                                                       or len(line.decode()) >= min_chars):
                            rows.append(r)
                            pos.append(p)
                            keys.append(hashlib.blake2b(line, digest_size=16).digest())
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at),
                     pa.array(pos, pa.int32()), pa.array(keys, pa.binary())],
                    names=["_doc", "_text_hash", "_pos", "_key"])

    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_text_hash"),
        F.col(text_col).alias("_text")).mapInArrow(run, LINES)


def postings(lines: DataFrame) -> DataFrame:
    """(_key, _doc), each once."""
    return lines.select("_key", "_doc").distinct()


def references(held: DataFrame) -> DataFrame:
    """The exact table: (_key, n_docs, last_doc) from distinct postings."""
    return held.groupBy("_key").agg(F.count(F.lit(1)).alias("n_docs"),
                                    F.max("_doc").alias("last_doc"))


def _shard(n: int):
    return F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int")


def shard_rows(repeated: DataFrame, n_shards: int) -> DataFrame:
    """(_shard, filter, keys, last_docs): a cuckoo filter and the exact table of each shard."""
    schema = "_shard int, filter binary, keys binary, last_docs binary"

    def build(batches):
        shard, keys, docs = None, [], []

        def made():
            f = CuckooFilter.of(_halves(keys))
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([f.to_bytes()], pa.binary()),
                pa.array([b"".join(keys)], pa.binary()),
                pa.array([np.array(docs, "<i8").tobytes()], pa.binary())],
                names=["_shard", "filter", "keys", "last_docs"])

        for batch in batches:
            for s, key, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    if keys:
                        yield made()
                    shard, keys, docs = s, [], []
                keys.append(key)
                docs.append(doc)
        if keys:
            yield made()

    return repeated.select(_shard(n_shards).alias("_shard"), "_key", "last_doc").repartition(
        "_shard").sortWithinPartitions("_shard").mapInArrow(build, schema)


def shard_salts(repeated: DataFrame, n_shards: int, n_lines: int, parts: int) -> DataFrame:
    """(_salted, n_salts): each shard's salts, an even share of ``parts``, or as many as the
    postings of its repeated keys are worth among all lines; together at most
    2 parts + 2 n_shards while the postings are lines of this run."""
    own = F.ceil(F.col("n") * parts / F.lit(float(max(n_lines, 1))))
    return repeated.groupBy(_shard(n_shards).alias("_salted")).agg(
        F.sum("n_docs").alias("n")).select("_salted", F.greatest(
            F.lit(max(1, parts // n_shards)), F.least(own, F.lit(parts))).cast("int").alias(
                "n_salts"))


def repeated_lines(lines: DataFrame, shards: DataFrame, n_shards: int, salts: DataFrame
                   ) -> DataFrame:
    """(_doc, _text_hash, _pos) of the lines to drop: their key is repeated and their
    document is not the last one holding it."""
    # a shard without salts has no repeated key: its lines drop out here
    line = lines.join(F.broadcast(salts), _shard(n_shards) == F.col("_salted")).select(
        F.col("_salted").alias("_shard"),
        F.pmod(F.xxhash64("_doc"), F.col("n_salts")).cast("int").alias("_salt"),
        F.lit(1).alias("_kind"), "_key", "_doc", "_text_hash", "_pos",
        F.lit(None).cast("binary").alias("filter"), F.lit(None).cast("binary").alias("last_docs"))
    row = shards.join(F.broadcast(salts), F.col("_shard") == F.col("_salted")).select(
        "_shard", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("_salt"),
        F.lit(0).alias("_kind"), F.col("keys").alias("_key"), F.lit(0).cast("long").alias("_doc"),
        F.lit(0).cast("long").alias("_text_hash"), F.lit(0).alias("_pos"), "filter", "last_docs")
    met = row.union(line).repartition("_shard", "_salt").sortWithinPartitions(
        "_shard", "_salt", "_kind")

    def probe(batches):
        at, found, last = None, None, {}
        for batch in batches:
            shard, kind = batch.column(0), batch.column(2).to_numpy()
            shard, salt = shard.to_numpy(), batch.column(1).to_numpy()
            new = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0)
                                 | (kind[1:] == 0)) + 1
            for a, b in zip([0, *new], [*new, len(shard)]):
                if kind[a] == 0:
                    keys = batch.column(3)[a].as_py()
                    docs = np.frombuffer(batch.column(8)[a].as_py(), "<i8").tolist()
                    at = (shard[a], salt[a])
                    found = CuckooFilter.from_bytes(batch.column(7)[a].as_py())
                    last = {keys[16 * i:16 * i + 16]: d for i, d in enumerate(docs)}
                    a += 1
                if a >= b or (shard[a], salt[a]) != at:
                    continue                             # no repeated key in this shard
                part = batch.slice(a, b - a)
                keys = part.column(3).to_pylist()
                docs = part.column(4).to_pylist()
                hits = np.flatnonzero(found.contains(_halves(keys))).tolist()
                drop = pa.array([i for i in hits if last.get(keys[i], docs[i]) != docs[i]],
                                pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(c).take(drop) for c in (4, 5, 6)],
                                                 names=["_doc", "_text_hash", "_pos"])

    return met.mapInArrow(probe, "_doc long, _text_hash long, _pos int")


def drop_lines(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str,
               counts: bool = True) -> DataFrame:
    """``docs`` without the lines at the given places; with ``counts`` also n_lines and
    n_dropped (in place of columns of these names)."""
    gone = drops.groupBy("_doc", "_text_hash").agg(F.collect_set("_pos").alias("_drop"))
    # all other columns travel as one struct, so that no name can clash
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others or [F.lit(0).alias("none")]).alias("_row"),
                       F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"),
                       F.col(text_col).alias("_text"))
    joined = rows.join(gone, (F.col("_id") == F.col("_doc")) & (F.col("_hash")
                                                                == F.col("_text_hash")), "left")

    def rewrite(batches):
        for batch in batches:
            gone, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out, lines = [], []
            for drop, text in zip(gone, texts):
                if not drop:
                    lines.append((text or "").count("\n") + 1)
                    out.append(text)
                    continue
                own, drop = text.split("\n"), set(drop)
                lines.append(len(own))
                out.append("\n".join([x for i, x in enumerate(own) if i not in drop]))
            yield pa.RecordBatch.from_arrays([
                batch.column(2), pa.array(out, pa.string()), pa.array(lines, pa.int64()),
                pa.array([len(d or ()) for d in gone], pa.int64())],
                names=["_row", "_kept", "n_lines", "n_dropped"])

    made = joined.select("_drop", "_text", "_row").mapInArrow(rewrite, StructType([
        rows.schema["_row"], StructField("_kept", StringType()), StructField("n_lines", LongType()),
        StructField("n_dropped", LongType())]))
    added = ["n_lines", "n_dropped"] if counts else []
    return made.select(*[F.col("_kept").alias(c) if c == text_col else F.col("_row")[c].alias(c)
                         for c in docs.columns if c not in added], *added)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                held: DataFrame | None = None, counts: bool = True) -> DataFrame:
    """All rows of ``docs`` with repeated lines taken out; with ``counts`` also n_lines and
    n_dropped.

    ``held``: postings of a ``LineState`` to count as well (incremental use).
    """
    spark = docs.sparkSession
    lines = written(line_keys(docs, id_col, text_col, min_chars), "lines")
    own = postings(lines)
    refs = references(own if held is None else own.unionByName(held).distinct())
    repeated = written(refs.where(F.col("n_docs") >= min_docs), "references")
    n_shards = max(1, -(-repeated.count() // SHARD_KEYS * 5 // 4))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = written(shard_salts(repeated, n_shards, lines.count(), parts), "salts")
    drops = repeated_lines(lines, shard_rows(repeated, n_shards), n_shards, salts)
    return drop_lines(docs, drops, id_col, text_col, counts)


class LineState:
    """The postings of all documents so far, as signed batches in a shared folder."""

    SCHEMA = "_key binary, _doc long, change int"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_folder(spark, "line-state")
        self.batches: list[str] = []

    def _write(self, rows: DataFrame, batch: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{batch}")
        if batch not in self.batches:
            self.batches.append(batch)

    def insert(self, docs: DataFrame, batch: str, **columns) -> None:
        """Add the lines of a batch of documents; the same batch id again changes nothing."""
        self._write(postings(line_keys(docs, **columns)).withColumn("change", F.lit(1)), batch)

    def delete(self, docs: DataFrame, batch: str, **columns) -> None:
        """Take the lines of these documents out again."""
        self._write(postings(line_keys(docs, **columns)).withColumn("change", F.lit(-1)), batch)

    def postings(self) -> DataFrame:
        """The (key, document) pairs that stand after all batches."""
        if not self.batches:
            return self.spark.createDataFrame([], "_key binary, _doc long")
        rows = self.spark.read.schema(self.SCHEMA).parquet(
            *(f"{self.path}/{b}" for b in self.batches))
        return rows.groupBy("_key", "_doc").agg(F.sum("change").alias("n")).where(
            "n > 0").select("_key", "_doc")

    def references(self) -> DataFrame:
        return references(self.postings())


def update_shards(shards: DataFrame, gained: DataFrame, lost: DataFrame, n_shards: int
                  ) -> DataFrame:
    """Shard rows after keys became repeated (``gained``: _key, last_doc) or no longer
    are (``lost``: _key): the filters take insertions and deletions in place and are
    rebuilt from the shard's exact table only when full."""
    rows = shards.select("_shard", F.lit(0).alias("_kind"), F.col("keys").alias("_key"),
                         F.lit(0).cast("long").alias("last_doc"), "filter", "last_docs")
    none = F.lit(None).cast("binary")
    for kind, change in ((1, lost.withColumn("last_doc", F.lit(0).cast("long"))), (2, gained)):
        rows = rows.union(change.select(_shard(n_shards).alias("_shard"), F.lit(kind),
                                        "_key", "last_doc", none, none))
    rows = rows.repartition("_shard").sortWithinPartitions("_shard", "_kind")

    def run(batches):
        shard, table, found = None, {}, None

        def made():
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([found.to_bytes()], pa.binary()),
                pa.array([b"".join(table)], pa.binary()),
                pa.array([np.array(list(table.values()), "<i8").tobytes()], pa.binary())],
                names=["_shard", "filter", "keys", "last_docs"])

        for batch in batches:
            for s, kind, key, doc, raw, docs in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    if table:
                        yield made()
                    shard, table, found = s, {}, CuckooFilter(4)
                if kind == 0:
                    found = CuckooFilter.from_bytes(raw)
                    table = {key[16 * i:16 * i + 16]: d
                             for i, d in enumerate(np.frombuffer(docs, "<i8").tolist())}
                elif kind == 1 and key in table:
                    found.delete(_halves([key])[0])
                    del table[key]
                elif kind == 2:
                    new = key not in table
                    table[key] = doc
                    if new and not found.insert(_halves([key])[0]):
                        found = CuckooFilter.of(_halves(list(table)))
        if table:
            yield made()

    return rows.mapInArrow(run, "_shard int, filter binary, keys binary, last_docs binary")


def digests(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(
           trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.last_doc <> k.doc_id AS gone
  FROM k LEFT JOIN r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""
