"""O-91: incremental ingest of landed files into a keyed table.

``readStream`` over the landing folder -> ``foreachBatch`` writes each
micro-batch to its own folder ``batches/batch=<id>``, replacing what an earlier
attempt of the same batch left. Nothing else is touched, so a batch costs its own
rows, and a crash at any point loses none: the stream replays an uncommitted batch.

``read_table`` resolves the duplicate policy on reading (first wins = insert-or-ignore,
last wins = insert-or-replace; batches by id, rows of a batch by ``order``).
``compact`` folds the resolved table into a new snapshot folder and then adds a pointer
row naming it and the last batch it holds. A crash before the pointer leaves the old
state valid; one after it, the new. Folded batches are then no longer read.

What cannot be ingested is kept beside it: ``quarantine/batch=<id>`` holds the file and the
reason of every broken record or payload file, and the record's text, replaced like the
batch itself when it is replayed. Rows and quarantine together are what landed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.operators.upsert import assign_ids, first_per_key, last_per_key
from corpuslink.session import written
from corpuslink.sources.files import list_files, seen_files
from corpuslink.sources.payloads import checked_payloads, listed_files, named_files, payload_rows

BATCH = "batch"
SEQ = "_seq"
POINTER = "version long, snapshot string, folded long"


def _read(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The rows under ``path``, none before anything was written there."""
    reader = spark.read.schema(schema)
    try:
        return reader.json(path) if fmt == "json" else reader.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _pointer(spark: SparkSession, target: str) -> tuple[int, str | None, int]:
    """(version, snapshot folder, last folded batch) of the newest pointer row."""
    rows = _read(spark, f"{target}/pointers", POINTER, "json")
    top = rows.orderBy(F.desc("version")).limit(1).collect()
    return (top[0].version, top[0].snapshot, top[0].folded) if top else (0, None, -1)


def apply_batch(batch: DataFrame, batch_id: int, target: str, schema: T.StructType) -> None:
    """Write one micro-batch; the same batch again replaces itself."""
    batch.select(*schema.fieldNames()).write.mode("overwrite").parquet(
        f"{target}/batches/{BATCH}={batch_id}")


QUARANTINE = "file string, reason string, record string"
BROKEN_RECORD, NO_KEY = "broken record", "no key"
CORRUPT = "_corrupt_record"


def apply_quarantine(bad: DataFrame, batch_id: int, target: str) -> None:
    bad.select("file", "reason", "record").write.mode("overwrite").parquet(
        f"{target}/quarantine/{BATCH}={batch_id}")


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """(file, reason, record, batch) of everything that was not ingested."""
    return _read(spark, f"{target}/quarantine", f"{QUARANTINE}, {BATCH} long")


def _rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    _, snapshot, folded = _pointer(spark, target)
    names = schema.fieldNames()
    full = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
    rows = _read(spark, f"{target}/batches", full).filter(F.col(BATCH) > folded).select(
        *names, F.col(BATCH).alias(SEQ))
    if snapshot is not None:
        base = spark.read.schema(schema).parquet(f"{target}/snapshots/{snapshot}")
        rows = base.select(*names, F.lit(-1).cast("long").alias(SEQ)).unionByName(rows)
    return rows


def read_table(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str],
               order: Sequence[str], policy: str = "ignore") -> DataFrame:
    """The current table, one row per key (empty before the first batch)."""
    pick = {"ignore": first_per_key, "replace": last_per_key}.get(policy)
    if pick is None:
        raise ValueError(policy)
    return pick(_rows(spark, target, schema), keys, [SEQ, *order]).select(*schema.fieldNames())


def compact(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str],
            order: Sequence[str], policy: str = "ignore", upto: int | None = None) -> None:
    """Fold all batches (up to a batch id that the stream has committed) into a snapshot."""
    version, _, folded = _pointer(spark, target)
    rows = _rows(spark, target, schema)
    if upto is not None:
        rows = rows.filter(F.col(SEQ) <= upto)
    last = rows.agg(F.max(SEQ)).first()[0]
    if last is None or last <= folded:
        return
    pick = first_per_key if policy == "ignore" else last_per_key
    name = uuid.uuid4().hex
    pick(rows, keys, [SEQ, *order]).select(*schema.fieldNames()).write.parquet(
        f"{target}/snapshots/{name}")
    spark.createDataFrame([(version + 1, name, last)], POINTER).coalesce(1).write.json(
        f"{target}/pointers", mode="append")


LEDGER = "batch long, first long, n long"


def reserve_ids(spark: SparkSession, ledger: str, batch_id: int, n: int) -> int:
    """O-13: the first of ``n`` ids for a batch, after all that were ever given out.

    The ledger has a row per batch (first id, count) and only grows, so ids of rows that are
    deleted later are not given again. A batch that comes again finds its own row; one with
    another number of rows is not the same batch and raises. One writer at a time.
    """
    mine = F.when(F.col("batch") == batch_id, F.struct("first", "n"))
    found = _read(spark, ledger, LEDGER, "json").agg(
        F.max(mine).alias("mine"), F.max(F.col("first") + F.col("n")).alias("next")).first()
    if found.mine is not None:
        if found.mine.n != n:
            raise ValueError(f"batch {batch_id} had {found.mine.n} new rows, now {n}")
        return found.mine.first
    first = found.next or 1
    spark.createDataFrame([(batch_id, first, n)], LEDGER).coalesce(1).write.json(
        ledger, mode="append")
    return first


def apply_batch_with_ids(batch: DataFrame, batch_id: int, target: str, schema: T.StructType,
                         keys: Sequence[str], order: Sequence[str], id_col: str = "id") -> None:
    """First wins, with ids that stay: the rows of a micro-batch whose key no earlier batch has,
    numbered densely by ``order`` (ties by key) after the ids of the batches before.

    The ids are reserved before the rows are written, and both depend on earlier batches
    only, so a batch that stops anywhere and runs again gives the same rows the same ids.
    ``read_table`` with ``schema`` and ``id_col`` (long) reads the table.
    """
    spark = batch.sparkSession
    full = T.StructType([*schema.fields, T.StructField(id_col, T.LongType())])
    known = _rows(spark, target, full).where(F.col(SEQ) < batch_id).select(*keys)
    new = written(first_per_key(batch.select(*schema.fieldNames()), keys, order).join(
        known, list(keys), "left_anti"), "new-rows")
    first = reserve_ids(spark, f"{target}/ledger", batch_id, new.count())
    apply_batch(assign_ids(new, [*order, *[k for k in keys if k not in order]], id_col,
                           start=first), batch_id, target, full)


def _started(frame: DataFrame, each_batch, checkpoint: str, available_now: bool):
    w = frame.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_ingest(spark: SparkSession, landing: str, target: str, checkpoint: str,
                  schema: T.StructType, fmt: str = "json", max_files: int | None = None,
                  available_now: bool = True, keys: Sequence[str] = ()):
    """Start the ingest query; with ``available_now`` it processes what has
    landed and stops (``query.awaitTermination()``).

    Records that are not JSON of the schema, and those without a value in one of ``keys``, go to
    the quarantine.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]) \
        if fmt == "json" else schema
    reader = spark.readStream.schema(full).format(fmt)
    if fmt == "json":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    src = reader.load(landing).select("*", F.col("_metadata.file_path").alias("_file"))
    corrupt = F.col(CORRUPT) if fmt == "json" else F.lit(None).cast("string")
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    reason = F.when(corrupt.isNotNull(), BROKEN_RECORD).when(keyless, NO_KEY)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        marked = df.withColumn("reason", reason).persist()
        apply_quarantine(marked.where(F.col("reason").isNotNull()).select(
            F.col("_file").alias("file"), "reason", F.coalesce(corrupt, F.to_json(F.struct(
                *schema.fieldNames()))).alias("record")), batch_id, target)
        apply_batch(marked.where(F.col("reason").isNull()), batch_id, target, schema)
        marked.unpersist()

    return _started(src, each_batch, checkpoint, available_now)


PAYLOAD_ROWS = T.StructType([
    T.StructField("book_number", T.IntegerType()), T.StructField("chapter", T.IntegerType()),
    T.StructField("verse", T.LongType()), T.StructField("text", T.StringType())])


NOTED_A_TASK = 20_000


def note_landed(listed: DataFrame, notes: str, max_files: int | None = None) -> None:
    """Add the files of a listing that ``notes`` has not: a Parquet file for each ``max_files`` of
    them, oldest first (ties by name), so that a stream of the notes takes them as batches."""
    known = _read(listed.sparkSession, notes, listed.schema).select("file")
    new = written(seen_files(listed).join(known, "file", "left_anti").select(*listed.columns), "new")
    n = new.count()
    new = written(assign_ids(new, ["modified", "file"], "_n", -(-n // NOTED_A_TASK), 0), "noted") \
        if n else new
    each = max_files or max(n, 1)
    for first in range(0, n, each):                       # one after another: the stream's order
        new.where(F.col("_n").between(first, first + each - 1)).drop("_n").coalesce(1) \
            .write.mode("append").parquet(notes)


def stream_payloads(spark: SparkSession, landing: str, target: str, checkpoint: str,
                    policy: str = "fetch", max_files: int | None = None,
                    available_now: bool = True):
    """O-91 for chapter payload files (O-01, O-02): their verses into the table
    (``read_table(..., PAYLOAD_ROWS, ["book_number", "chapter", "verse"], ["text"])``), files
    that give none into the quarantine, both by batch. Files of no bytes a stream does not
    see; ``payloads.empty_files`` lists them.

    Spark's file stream keeps the name of every file on the driver. With ``available_now`` the
    tasks list what has landed, ``<checkpoint>/landed`` notes what is new, ``max_files`` in a
    file, and the stream follows the notes. A checkpoint is of one kind: one made by Spark's file
    stream goes on as such, and a stream that waits for files cannot follow notes.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    notes = hadoop.Path(f"{checkpoint}/landed")
    system = notes.getFileSystem(spark._jsc.hadoopConfiguration())
    noted = system.exists(notes)
    if noted and not available_now:
        raise ValueError(f"{checkpoint} is of a stream with available_now")
    plain = not noted and system.exists(hadoop.Path(f"{checkpoint}/offsets"))
    listed = list_files(spark, landing) if available_now and not plain else None

    def each_batch(df: DataFrame, batch_id: int) -> None:
        files = df if listed is None else listed_files(df)
        checked = checked_payloads(files.withColumn("record", F.col("value")), policy).persist()
        apply_quarantine(checked.where(F.col("reason").isNotNull()), batch_id, target)
        apply_batch(payload_rows(checked), batch_id, target, PAYLOAD_ROWS)
        checked.unpersist()

    if listed is not None:
        system.mkdirs(notes)
        note_landed(listed, notes.toString(), max_files)
        return _started(spark.readStream.schema(listed.schema).option("maxFilesPerTrigger", 1)
                        .parquet(notes.toString()), each_batch, checkpoint, available_now)
    reader = spark.readStream.format("text").option("wholetext", True).option(
        "recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _started(named_files(reader.load(landing)), each_batch, checkpoint, available_now)
