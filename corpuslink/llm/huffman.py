"""Token ids in files of canonical, length-limited Huffman codes.

The file format (Parquet rows, so any Hadoop file system carries it):

* ``codebook``: one row (id, length) for each id that occurs. Codes are canonical:
  ordered by (length, id), so the lengths alone give them.
* ``blocks``: one row per independent block of whole documents, about ``block_ids``
  ids. ``part`` and ``block`` ascend with the document id, ``part_start`` counts the
  ids of the part before the block, ``doc_ids`` and ``doc_sizes`` list its documents
  in ascending order. ``bits`` joins their codes, each document from a fresh byte;
  ``marks`` holds the bit offset of every document and of every ``MARK``-th id within
  it (little-endian 64-bit), so a reader can start at any of them.

Decoding is by table: the next ``MAX_BITS`` bits index the id and its code length. All
marks of a block advance together, one id a step.

Nulls, empties: a null or empty text is its end id alone. A null document id comes
first. Repeated rows are written as often as they occur (ordered by their codes).
Extra columns are not read; an empty table gives no blocks and an empty codebook.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuslink.llm import tokens as TK
from corpuslink.llm.scratch import new_folder, written

MAX_BITS = 16          # longest code; also the decoding table's index width
MARK = 512             # ids between two bit offsets of a document
IDS = 1 << 16          # ids are below this


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for each count (package merge);
    0 where the count is 0. One single id gets one bit."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, below = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, below])
        by = np.argsort(both, kind="stable")
        levels.append(by < len(leaves))
        both = both[by]
        m = len(both) // 2 * 2
        below = both[:m:2] + both[1:m:2]
    take = 2 * len(leaves) - 2
    lengths = np.zeros(len(leaves), np.int64)
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of each id as an integer of its length."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        length = lengths[used].astype(np.int64)
        share = np.int64(1) << (MAX_BITS - length)
        codes[used] = ((np.cumsum(share) - share) >> (MAX_BITS - length)).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For every MAX_BITS bits: id * 32 + code length."""
    table = np.zeros(1 << MAX_BITS, np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        share = 1 << (MAX_BITS - lengths[used].astype(np.int64))
        filled = np.repeat(used.astype(np.uint32) * 32 + lengths[used], share)
        table[:len(filled)] = filled
    return table


def encode_ids(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray
               ) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """(byte start of each document and the end, all bytes, marks relative to their
    document in bits, number of marks of each document)."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    first = np.cumsum(sizes) - sizes
    base = ends[first] - size[first]                       # bits before each document
    last = ends[first + sizes - 1]
    starts = np.concatenate([[0], np.cumsum((last - base + 7) >> 3)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    within = ends - size - base[doc]
    at = within + 8 * starts[doc]
    value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    word = at >> 5
    n = int(starts[-1] + 3) // 4 + 2
    packed = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n) + np.bincount(
        word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    raw = packed.astype(np.uint64).astype(">u4").tobytes()[:int(starts[-1])]
    number = np.arange(len(ids)) - first[doc]
    return starts, raw, within[number % MARK == 0], (sizes + MARK - 1) // MARK


def decode_bits(raw: bytes, marks: np.ndarray, counts: np.ndarray, table: np.ndarray
                ) -> np.ndarray:
    """The ids from each mark on (``counts`` of them), joined."""
    if not len(marks):
        return np.zeros(0, np.uint32)
    b = np.frombuffer(raw + b"\0\0\0\0", np.uint8).astype(np.uint32)
    ahead = (b[:-3] << 16) | (b[1:-2] << 8) | b[2:-1]       # 24 bits from each byte on
    order = np.argsort(-counts, kind="stable")
    pos, left = marks[order].astype(np.int64), counts[order]
    out = np.zeros((int(left[0]), len(marks)), np.uint32)
    live = np.searchsorted(-left, -np.arange(1, len(out) + 1), "right")
    for k in range(len(out)):
        p = pos[:live[k]]
        found = table[(ahead[p >> 3] >> (8 - (p & 7)).astype(np.uint32)) & 0xFFFF]
        out[k, :live[k]] = found
        p += found & 31
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    kept = (np.arange(len(out))[:, None] < left[None, :]).T[back]
    return (out.T[back])[kept] >> 5


def token_table(docs: DataFrame, id_col: str, text_col: str, tokenizer: str,
                end_id: int) -> DataFrame:
    """(doc_id, ids): ids as little-endian 16-bit integers, the end id last."""
    path = TK.tokenizer_path(tokenizer)

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = TK.encoder(path, "<u2").encode
        for batch in batches:
            for at, rows in TK.slices(batch.column(1)):
                ids, sizes = encode(batch.column(1).slice(at, rows))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                ends = np.concatenate([[0], np.cumsum(sizes + 1)]) * 2
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, rows),
                    pa.Array.from_buffers(pa.binary(), rows, [
                        None, pa.py_buffer(ends.astype("<i4").tobytes()),
                        pa.py_buffer(ids.tobytes())])], names=["doc_id", "ids"])
        TK.release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def id_counts(table: DataFrame) -> DataFrame:
    """(id, n) over the whole token table; each task sends a row per id at most."""
    def run(batches):
        TK.forget()
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                raw = b"".join(batch.column(0).slice(k, 1024).to_pylist())
                total += np.bincount(np.frombuffer(raw, "<u2"), minlength=IDS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])],
                                         names=["id", "n"])

    return table.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


def lengths_of(codebook: DataFrame) -> np.ndarray:
    """Code lengths by id: at most 65,536 rows, whatever the corpus."""
    lengths = np.zeros(IDS, np.uint8)
    for i, n in codebook.select("id", "length").collect():
        lengths[i] = n
    return lengths


def _cut_at(coded: DataFrame, table: DataFrame, parts: int) -> DataFrame:
    """The encoded rows dealt to ``part`` by ascending document id and sorted there."""
    probs = [k / parts for k in range(1, parts)]
    found = table.select("doc_id").stat.approxQuantile("doc_id", probs, 0.2 / parts) \
        if probs else []
    part = F.lit(0)
    if found:
        bounds = F.array(*[F.lit(int(c)) for c in sorted(set(found))])
        part = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))), F.lit(0))
    return coded.withColumn("part", part.cast("int")).repartition(
        parts, "part").sortWithinPartitions("part", "doc_id", "raw")


def write_ids(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
              block_ids: int = 1 << 18) -> None:
    """Encode all texts and write the files under ``path``."""
    spark = docs.sparkSession
    table = written(token_table(docs, id_col, text_col, tokenizer, end_id), "tokens")
    counts = np.zeros(IDS, np.int64)
    for i, n in id_counts(table).collect():               # at most 65,536 rows
        counts[i] = n
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)],
                          "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast(lengths)          # 64 KB

    def encode(batches):
        lengths = book.value
        codes = canonical_codes(lengths)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                raws = part.column(1).to_pylist()
                sizes = np.array([len(r) // 2 for r in raws], np.int64)
                ids = np.frombuffer(b"".join(raws), "<u2")
                starts, raw, marks, per_doc = encode_ids(ids, sizes, lengths, codes)
                cut = np.concatenate([[0], np.cumsum(per_doc)]) * 8
                marks = marks.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes),
                    pa.array([raw[a:b] for a, b in zip(starts[:-1], starts[1:])], pa.binary()),
                    pa.array([marks[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                ], names=["doc_id", "size", "raw", "marks"])

    def block(batches):
        held: list[tuple] = []
        part, size, number, start = None, 0, 0, 0

        def flush():
            nonlocal held, size, number, start
            at = np.cumsum([0, *(len(r[2]) for r in held)]) * 8
            marks = np.concatenate([np.frombuffer(r[3], "<i8") + a for r, a in zip(held, at)])
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                pa.array([start], pa.int64()), pa.array([size], pa.int64()),
                pa.array([[r[0] for r in held]], pa.list_(pa.int64())),
                pa.array([[r[1] for r in held]], pa.list_(pa.int64())),
                pa.array([marks.astype("<i8").tobytes()], pa.binary()),
                pa.array([b"".join(r[2] for r in held)], pa.binary()),
            ], names=["part", "block", "part_start", "n_ids", "doc_ids", "doc_sizes", "marks",
                      "bits"])
            number, start, held, size = number + 1, start + size, [], 0
            return row

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[0] != part or size >= block_ids):
                    yield flush()
                if row[0] != part:
                    part, number, start = row[0], 0, 0
                held.append(row[1:])
                size += row[2]
        if held:
            yield flush()

    coded = table.mapInArrow(encode, "doc_id long, size long, raw binary, marks binary")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the cuts come from the written ids alone, so that nothing is encoded twice
    ordered = _cut_at(coded, table, parts)
    ordered.select("part", "doc_id", "size", "raw", "marks").mapInArrow(
        block, "part int, block long, part_start long, n_ids long, doc_ids array<long>, "
               "doc_sizes array<long>, marks binary, bits binary"
    ).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: (doc_id, start, n_tokens, ids), ids as little-endian
    unsigned 32-bit integers, ``start`` counting the ids of all documents before it."""
    table = spark.sparkContext.broadcast(decoding_table(lengths_of(
        spark.read.schema("id long, length int").parquet(f"{path}/codebook"))))
    blocks = spark.read.schema(
        "part int, block long, part_start long, n_ids long, doc_ids array<long>, "
        "doc_sizes array<long>, marks binary, bits binary").parquet(f"{path}/blocks")
    # one row per part, as many as files were written
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("before"))

    def decode(batches):
        TK.forget()
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["doc_sizes"], np.int64)
                per_doc = (sizes + MARK - 1) // MARK
                counts = np.full(int(per_doc.sum()), MARK, np.int64)
                counts[np.cumsum(per_doc) - 1] = sizes - MARK * (per_doc - 1)
                ids = decode_bits(row["bits"], np.frombuffer(row["marks"], "<i8"), counts,
                                  table.value)
                ends = np.cumsum(sizes)
                offsets = pa.py_buffer(np.concatenate([[0], ends * 4]).astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(sizes), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["part_start"] + ends - sizes), pa.array(sizes),
                    pa.Array.from_buffers(pa.binary(), len(sizes),
                                          [None, offsets, pa.py_buffer(ids.tobytes())]),
                ], names=["part", "doc_id", "in_part", "n_tokens", "ids"])

    docs = blocks.select("part", "part_start", "doc_ids", "doc_sizes", "marks", "bits").mapInArrow(
        decode, "part int, doc_id long, in_part long, n_tokens long, ids binary")
    # at most one row per written file: a few hundred thousand of them are a few MB
    return docs.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("in_part")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write all documents to a fresh folder and read them back."""
    spark = docs.sparkSession
    path = new_folder(spark, "token-files")
    write_ids(docs, path, **options)
    return read_ids(spark, path)


def digests(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
