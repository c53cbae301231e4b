"""WARC archives of a table of pages: a writer that stores equal payloads once, and a reader
that salvages what is intact around damaged bytes.

Writer: the payload of a record is an HTTP response. Of the rows with equal payloads (by their
sha256) that with the smallest id is a ``response``; the others are ``revisit`` records that
refer to it and hold the HTTP head only. Records are rendered in tasks and written by Spark's text
writer, whose row separator is the four bytes that end a record (or, with ``gz``, an empty gzip
member between the records' own members): its commit makes a retried task's file count once, on
any file system. Files hold about ``file_bytes``.

Which row is first is one partial aggregate by payload digest. The answers go back to the rows in
two joins: digests that more than a thousandth of all rows share are a thousand at most and are
broadcast; rows with such a digest then spread by their id in the join with all others, so
that no key of it holds more than a thousandth of the rows.

Reader: a file is one task's work (Spark's ``binaryFile`` source, so a file and its records must
fit a task's memory; the writer's files do). At every position the record must pass all checks:
a version line, a head with a length, a block of that length followed by the ending, block and payload
digests that agree; a gzip member must inflate to its end with the right checksum, and its
records must pass in turn. After a failed check the reader looks for the next byte at which a
member or version line begins a record that passes, logs the bytes between as a gap with the
reason of the first failure, and goes on. A record quoted in a damaged record's payload is found
like any other.

Defined results: null payloads are empty; empty payloads are equal to each other. A null url gives
no target field; control characters in it are percent-encoded. Rows that share the smallest id and the
payload are all responses. A null id is larger than any other and reads back as null; a payload of
null ids only has responses only. Empty tables give no files and read back empty. Payloads
may be of any size up to what a task can hold. Extra columns are not stored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_folder

END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]")
#: An empty gzip member (fixed by the format): it may stand between any two others.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300") + bytes(8)
FILE_BYTES = 32 << 20
HOT_SHARE = 1000                # digests of more than 1/HOT_SHARE of all rows are broadcast
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("kind string, file string, offset long, length long, reason string, type string, "
           "id string, refers_to string, url string, payload_bytes long, "
           "payload_digest string, payload binary")
ARROW = pa.schema([
    ("kind", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("reason", pa.string()), ("type", pa.string()), ("id", pa.string()),
    ("refers_to", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary())])


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def row_urn(value: str | None) -> bytes:
    return b"<urn:null:>" if value is None else b"<urn:row:" + quote(value, safe="").encode() + b">"


def urn_row(value: str | None) -> str | None:
    """The row id of a record id; a foreign record's id as it stands."""
    if value is None or value == "<urn:null:>":
        return None
    found = re.fullmatch(r"<urn:row:(.*)>", value)
    return unquote(found[1]) if found else value


def render(row_id: str | None, url: str | None, payload: bytes, refers_to: str | None,
           date: str) -> bytes:
    """A response record, or a revisit of ``refers_to``, without its ending."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % len(payload))
    block = head + payload if refers_to is None else head
    lines = [b"WARC/1.1",
             b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
             b"WARC-Record-ID: " + row_urn(row_id), b"WARC-Date: " + date.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + re.sub(
            rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode("utf-8", "replace")))
    if refers_to is not None:
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + row_urn(refers_to)]
    lines += [b"WARC-Block-Digest: sha1:" + base32_sha1(block).encode(),
              b"WARC-Payload-Digest: sha1:" + base32_sha1(payload).encode(),
              b"Content-Type: application/http; msgtype=response",
              b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block


def member(record: bytes) -> bytes:
    """A gzip member of its own for a whole record."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


def with_first(rows: DataFrame, min_bytes: int) -> tuple[DataFrame, int]:
    """``rows`` (id, url, payload, key) with ``first``, the id to refer to (null: none), and
    the mean payload size."""
    total, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("payload"))).first()
    shared = rows.where(F.octet_length("payload") >= min_bytes).groupBy("key").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = shared.where(F.col("n") * HOT_SHARE > total).select(
        F.col("key").alias("hot_key"), F.col("first").alias("hot_first"))
    cold = shared.where(F.col("n") * HOT_SHARE <= total).select(
        F.col("key").alias("place"), F.col("first").alias("cold_first"))
    known = rows.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
    placed = known.withColumn("place", F.when(
        F.col("hot_key").isNotNull(), F.concat(F.lit("hot "), F.hash("id", "url").cast("string"))
    ).otherwise(F.col("key")))
    both = placed.join(cold.hint("shuffle_hash"), "place", "left").withColumn(
        "first", F.coalesce("hot_first", "cold_first"))
    return both.select("id", "url", "payload", F.when(
        ~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first")), \
        (size or 0) // max(1, total)


def write_archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, gz: bool = True,
                  file_bytes: int = FILE_BYTES, date: str | None = None) -> None:
    """Write a record per row below ``path``; payloads under ``min_bytes`` are never revisits."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("key", F.sha2("payload", 256))
    found, mean = with_first(rows, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for row_id, url, payload, first in zip(
                        *(c.to_pylist() for c in batch.slice(k, 256).columns)):
                    record = render(row_id, url, payload, first, date)
                    out.append(member(record + END) if gz else record)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rendered = found.select(F.col("id").cast("string"), "url", "payload",
                            F.col("first").cast("string")).mapInArrow(run, "value binary")
    separator = EMPTY_MEMBER if gz else END
    rendered.select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", separator.decode("latin-1")).option("encoding", "ISO-8859-1").option(
        "compression", "none").option(
        "maxRecordsPerFile", max(1, file_bytes // (mean + 512))).text(path)


class Damaged(Exception):
    """A check that failed; its text is the reason."""


def parse_record(data: bytes, at: int) -> tuple[int, dict]:
    """The end and the row of the record that begins at ``at``; raises Damaged."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    head_end = data.find(END, version.end() - 2)
    if head_end < 0:
        raise Damaged("head without end")
    fields: dict[str, str] = {}
    for line in data[version.end():head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            raise Damaged("head line without colon")
        fields.setdefault(name.strip().lower().decode("latin-1"),
                          value.strip().decode("utf-8", "replace"))
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise Damaged(f"no {name}")
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", length):
        raise Damaged("no content length")
    start = head_end + len(END)
    end = start + int(length)
    if end + len(END) > len(data):
        raise Damaged("cut off")
    if data[end:end + len(END)] != END:
        raise Damaged("no ending after the block")
    block = data[start:end]
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise Damaged("block digest differs")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(END)
        told = re.search(rb"(?im)^content-length:\s*([0-9]+)\s*$", http)
        size = len(payload)
    kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    if kind == "revisit":                     # the payload lies in the record referred to
        size = int(told[1]) if "http" in fields.get("content-type", "") and told else None
        payload, real = None, stated[5:] if stated.startswith("sha1:") else None
    else:
        real = base32_sha1(payload)
        if stated.startswith("sha1:") and stated[5:] != real:
            raise Damaged("payload digest differs")
    return end + len(END), {
        "type": kind, "id": urn_row(fields.get("warc-record-id")),
        "refers_to": urn_row(fields.get("warc-refers-to")), "url": fields.get("warc-target-uri"),
        "payload_bytes": size, "payload_digest": real, "payload": payload}


def inflate(data: memoryview, at: int) -> tuple[int, bytes]:
    """The end and the content of the gzip member that begins at ``at``; raises Damaged."""
    expand = zlib.decompressobj(31)
    out, k = [], at
    try:
        while not expand.eof:
            if k >= len(data):
                raise Damaged("gzip member cut off")
            out.append(expand.decompress(data[k:k + 65536]))
            k += 65536
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return min(k, len(data)) - len(expand.unused_data), b"".join(out)


def parse_at(data: bytes, view: memoryview, at: int) -> tuple[int, list[dict]]:
    """The end and the rows of the member or record that begins at ``at``; raises Damaged."""
    if data.startswith(MAGIC, at):
        end, content = inflate(view, at)
        rows, k = [], 0
        while k < len(content):
            k, row = parse_record(content, k)
            rows.append(row)
        return end, rows
    end, row = parse_record(data, at)
    return end, [row]


def salvage(data: bytes) -> Iterator[dict]:
    """All intact records of a file, and the gaps between them, in file order."""
    view, at = memoryview(data), 0
    while at < len(data):
        try:
            end, rows = parse_at(data, view, at)
        except Damaged as first:
            reason, start, rows, end = str(first), at, [], len(data)
            for begin in BEGIN.finditer(data, start + 1):
                try:
                    end, rows = parse_at(data, view, begin.start())
                    at = begin.start()
                    break
                except Damaged:
                    continue
            else:
                at = len(data)
            yield {"kind": "gap", "offset": start, "length": at - start, "reason": reason}
        for row in rows:
            yield {"kind": "record", "offset": at, "length": end - at, **row}
        at = max(end, at)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per record (kind ``record``) and per quarantined stretch of bytes (kind ``gap``,
    with its offset, length and reason) of all files below ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                held, size = [], 0
                for row in salvage(data):
                    held.append({"file": name, **row})
                    size += len(row.get("payload") or b"") + 256
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, ARROW)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        run, RECORDS)


def records(archive: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The records of ``read_archive``, row ids cast to the type they had."""
    return archive.where("kind = 'record'").withColumns({
        c: F.col(c).cast(id_type) for c in ("id", "refers_to")}).drop("kind", "reason")


def gaps(archive: DataFrame) -> DataFrame:
    return archive.where("kind = 'gap'").select("file", "offset", "length", "reason")


def digests(pages: DataFrame) -> DataFrame:
    """The contract's columns: all pages written to a fresh folder and read back."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write_archive(pages, path)
    return records(read_archive(spark, path)).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), "refers_to")


_BIT = ("(strpos('0123456789abcdef', substr(hex, {k} // 4 + 1, 1)) - 1) >> (3 - {k} % 4) & 1")
_DIGIT = " + ".join(f"{16 >> j} * ({_BIT.format(k=f'(5 * i + {j})')})" for j in range(5))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ({_DIGIT})::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response'
            ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p
"""
