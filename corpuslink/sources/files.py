"""Many small text files written, listed and read by the tasks themselves (O-02, O-09).

Spark's writers pay for every file as for a table: a folder for the attempt, a checksum file, a
change of mode for each (on a local disk a process of its own), and a rename that the driver
makes one after another at the end. Here a task writes its files through pyarrow, by the folder's
URI, into a staging folder beside the target; one rename of that folder shows them all.

Spark's sources list files on the driver, which keeps a status, a folder and a split for each. Here
the folders of a level are listed by tasks, and the listing is a written table that tasks read the
files of: nothing of a file comes to the driver. Where pyarrow has no such file system, callers
read through Spark's sources.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.session import written

#: How Spark names the folder of a null or empty value, and the characters it escapes in others.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {ord(c): f"%{ord(c):02X}" for c in '"#%\'*/:=?\\\x7f{[]^' + "".join(map(chr, range(1, 32)))}
FILE = "part-00000.txt"

#: Folders that a task lists, files and bytes that a task reads, bytes of a batch of texts.
FOLDERS_A_TASK, FILES_A_TASK, BYTES_A_TASK, BATCH_BYTES = 500, 1000, 64 << 20, 4 << 20
#: ``uri`` and ``place``: the folder asked for and the file as tasks open them; ``file``: as Hadoop
#: names it; ``hidden``: Spark's sources pass over it.
LISTED = "uri string, place string, file string, folder boolean, hidden boolean, size long, " \
    "modified timestamp"


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name)


def encoded(path: str) -> str:
    """A path as Spark's ``_metadata.file_path`` has it: Java's quoting of a URI's path."""
    def quoted(c: str) -> str:
        if ord(c[0]) < 128 or unicodedata.category(c[0]) in ("Zs", "Zl", "Zp", "Cc"):
            return "".join(f"%{b:02X}" for b in c.encode())
        return c
    return re.sub(r"[^A-Za-z0-9_\-!.~'()*:@&=+$,;/]", lambda m: quoted(m[0]), path)


def list_files(spark: SparkSession, path: str) -> DataFrame | None:
    """(uri, place, file, hidden, size, modified) of every file below ``path``, a folder, file or
    pattern, found by the tasks, a level of folders at a time. None where only Hadoop has the file
    system, or nothing is there."""
    from pyarrow import fs
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    tops = []
    for status in system.globStatus(top) or []:
        uri, name = status.getPath().toUri().toASCIIString(), status.getPath().toString()
        try:
            place = fs.FileSystem.from_uri(uri)[1].rstrip("/")
        except (pa.ArrowException, OSError):
            return None
        if not name.endswith(place):
            return None
        tops.append((uri, name[:len(name) - len(place)], place))
    if not tops:
        return None

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system_of = {}
        for batch in batches:
            for row in batch.to_pylist():
                uri, place, file = row["uri"], row["place"], row["file"]
                if uri not in system_of:
                    system_of[uri] = fs.FileSystem.from_uri(uri)[0]
                if row["folder"]:
                    found = system_of[uri].get_file_info(fs.FileSelector(place))
                else:
                    found = [system_of[uri].get_file_info(place)]
                for at in range(0, len(found), 10_000):
                    some, before = found[at:at + 10_000], file[:len(file) - len(place)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([uri] * len(some), pa.string()),
                        pa.array([i.path for i in some], pa.string()),
                        pa.array([before + i.path for i in some], pa.string()),
                        pa.array([i.type == fs.FileType.Directory for i in some], pa.bool_()),
                        pa.array([row["hidden"] or (row["folder"] and _hidden(i.base_name))
                                  for i in some], pa.bool_()),
                        pa.array([i.size for i in some], pa.int64()),
                        pa.array([i.mtime_ns and i.mtime_ns // 1000 for i in some],
                                 pa.timestamp("us", "UTC"))],
                        names=["uri", "place", "file", "folder", "hidden", "size", "modified"])

    levels, n = [], len(tops)
    above = spark.createDataFrame([
        (uri, place, name + place, fs.FileSystem.from_uri(uri)[0].get_file_info(place).type
         == fs.FileType.Directory, False) for uri, name, place in tops],
        "uri string, place string, file string, folder boolean, hidden boolean")
    while n:
        levels.append(written(above.repartition(-(-n // FOLDERS_A_TASK)).mapInArrow(
            per_task, LISTED), "listed"))
        above = levels[-1].where("folder").select("uri", "place", "file", "folder", "hidden")
        n = above.count()
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    return found.where("NOT folder").drop("folder")


def seen_files(listed: DataFrame) -> DataFrame:
    """Those that Spark's sources would read."""
    return listed.where("size > 0 AND NOT hidden")


def reading_tasks(listed: DataFrame) -> int:
    """In how many tasks to read the files of a listing."""
    n, size = seen_files(listed).agg(F.count(F.lit(1)), F.sum("size")).first()
    return max(1, -(-n // FILES_A_TASK), -(-(size or 0) // BYTES_A_TASK))


def read_files(listed: DataFrame, *keep: str) -> DataFrame:
    """(file, value, keep..) of the files of ``list_files`` that hold something and are not hidden:
    the whole text of each, ``file`` as Spark's ``_metadata.file_path`` has it."""
    kept = [listed.schema[c] for c in keep]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system_of = {}
        for batch in batches:
            uris, places, files = (batch.column(i).to_pylist() for i in range(3))
            texts, since, held = [], 0, 0
            for at, (uri, place) in enumerate(zip(uris, places)):
                if uri not in system_of:
                    system_of[uri] = fs.FileSystem.from_uri(uri)[0]
                with system_of[uri].open_input_stream(place) as f:
                    texts.append(f.read())
                held += len(texts[-1])
                if held >= BATCH_BYTES or at + 1 == len(uris):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(map(encoded, files[since:at + 1]), pa.string()),
                         pa.array(texts, pa.binary()),
                         *[batch.column(3 + i).slice(since, at + 1 - since)
                           for i in range(len(kept))]],
                        names=["file", "value", *keep])
                    texts, since, held = [], at + 1, 0

    fields = ", ".join(["file string", "value binary",
                        *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept]])
    return seen_files(listed).select("uri", "place", "file", *keep).repartition(
        reading_tasks(listed)).mapInArrow(per_task, fields).withColumn(
        "value", F.col("value").cast("string"))


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move every file that ``write_files`` wrote under ``source`` into the folder of the same name
    under ``target``, over the one there; what else that folder holds goes. Done by the tasks;
    the same again completes what one left."""
    from pyarrow import fs
    listed = list_files(spark, source)
    hadoop = spark._jvm.org.apache.hadoop.fs
    top, into = (fs.FileSystem.from_uri(hadoop.Path(p).toUri().toASCIIString())[1].rstrip("/")
                 for p in (source, target))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        moved = 0
        for batch in batches:
            for row in batch.to_pylist():
                files = fs.FileSystem.from_uri(row["uri"])[0]
                place = into + row["place"][len(top):]
                folder = place.rpartition("/")[0]
                files.create_dir(folder, recursive=True)
                try:
                    files.move(row["place"], place)
                except FileNotFoundError:            # an earlier attempt of this task moved it
                    if files.get_file_info(place).type != fs.FileType.File:
                        raise
                for other in files.get_file_info(fs.FileSelector(folder)):
                    if other.path != place and other.type == fs.FileType.File:
                        files.delete_file(other.path)
                moved += 1
        yield pa.RecordBatch.from_arrays([pa.array([moved], pa.int64())], names=["moved"])

    listed.select("uri", "place").repartition(reading_tasks(listed)).mapInArrow(
        per_task, "moved long").write.format("noop").mode("overwrite").save()


def folder_name(column: str, value: str | None) -> str:
    """``column=value`` as Spark's partitioned writers name it."""
    return f"{column}={value.translate(ESCAPED) if value else NO_VALUE}"


def write_files(rows: DataFrame, path: str, keys: Sequence[str], text: str,
                order: Sequence[str] = ()) -> None:
    """One file of lines per value of ``keys``, in folders ``key=value/..`` that Spark reads as
    partitions; what was at ``path`` goes. Null and empty are one value.

    A file's lines follow ``order``; it is streamed row by row. A task that runs again or twice
    writes under a name of its own first and renames it, and nothing is seen at ``path`` before
    every task is done.
    """
    spark, keys = rows.sparkSession, list(keys)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = system.makeQualified(target)
    staging = hadoop.Path(target.getParent(), f"_staging-{uuid.uuid4().hex}")
    system.mkdirs(staging)
    place = staging.toString()

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        files, root = fs.FileSystem.from_uri(place)
        own = f".{uuid.uuid4().hex}"
        made, at, out, folder = 0, None, None, None

        def close():
            out.close()
            files.move(f"{folder}/{own}", f"{folder}/{FILE}")

        for batch in batches:
            *values, texts = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for *key, line in zip(*values, texts):
                if key != at:
                    if out is not None:
                        close()
                    at = key
                    folder = "/".join([root, *map(folder_name, keys, key)])
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(f"{folder}/{own}")
                    made += 1
                out.write(((line or "") + "\n").encode())
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], names=["files"])

    whole = rows.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in keys
                              if rows.schema[k].dataType.simpleString() == "string"})
    whole.repartition(*keys).sortWithinPartitions(*keys, *order).select(
        *[F.col(k).cast("string").alias(k) for k in keys], text).mapInArrow(
        per_task, "files long").write.format("noop").mode("overwrite").save()
    system.delete(target, True)
    if not system.rename(staging, target):
        raise OSError(f"{place} was not renamed to {path}")
