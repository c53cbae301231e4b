"""O-01 / O-02: chapter payload files (a JSON list of {verse, text} per chapter).

Re-aimed from HTTP fetches to landed files. Book number and chapter come from
partition folders ``book_number=N/chapter=M`` or, for flat files, from a
``{book_number}_{chapter}.json`` name. A file that is not a JSON list, not valid JSON
or without a usable verse gives no rows and is quarantined with the reason; the other
files continue, and every landed file is in the rows or in the quarantine.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.functions.text import ustrip
from corpuslink.schema import PAYLOAD_ITEM
from corpuslink.sources.files import list_files, read_files, write_files

NAME_PATTERN = r"(\d+)_(\d+)\.json$"
PLACE_PATTERN = r"book_number=(\d+)/chapter=(\d+)/[^/]*$"

LISTING_THREADS = 8

# Why a file holds no rows.
UNNAMED, NOT_A_LIST, BROKEN, NO_OBJECTS, NO_VERSES, EMPTY = (
    "no chapter in the name", "not a list", "broken JSON", "items that are no objects",
    "no usable verse", "empty file")


def _verses(items, policy: str):
    """The rows of a payload's list under a policy, as an array."""
    known = F.filter(items, lambda v: v.isNotNull())
    if policy == "fetch":
        clean = F.transform(known, lambda v: F.struct(
            F.coalesce(v["verse"], F.lit(0)).alias("verse"),
            ustrip(F.coalesce(v["text"], F.lit(""))).alias("text")))
        return F.filter(clean, lambda v: (v["verse"] != 0) & (v["text"] != ""))
    if policy == "backfill":
        clean = F.transform(known, lambda v: F.struct(
            v["verse"].alias("verse"), F.coalesce(v["text"], F.lit("")).alias("text")))
        return F.filter(clean, lambda v: v["verse"].isNotNull() & (v["text"] != ""))
    raise ValueError(policy)


def checked_payloads(files: DataFrame, policy: str = "fetch") -> DataFrame:
    """``files(book_number, chapter, value, ..)`` with ``verses``, the rows each file holds, and
    ``reason``, why it holds none (null for a good file): every file is the one or the other.

    ``'fetch'`` (O-01): missing verse -> 0, missing text -> '', keep verse <> 0
    and non-blank stripped text (stored stripped). ``'backfill'`` (O-02): text
    kept as is, only '' dropped, a missing verse stays NULL and is rejected.
    """
    items = F.from_json(F.col("value"), T.ArrayType(PAYLOAD_ITEM))
    is_list = F.coalesce(F.regexp_like(F.col("value"), F.lit(r"(?s)^\s*\[")), F.lit(False))
    named = F.col("book_number").isNotNull() & F.col("chapter").isNotNull()
    out = files.withColumn("_items", F.when(named & is_list, items))
    out = out.withColumn("verses", _verses(F.col("_items"), policy))
    return out.withColumn("reason", F.when(~named, UNNAMED).when(~is_list, NOT_A_LIST).when(
        F.col("_items").isNull(), F.when(F.from_json("value", "array<string>").isNull(), BROKEN)
        .otherwise(NO_OBJECTS)).when(F.size("verses") == 0, NO_VERSES)).drop(
        "value", "_items")


def payload_rows(checked: DataFrame, *more: str) -> DataFrame:
    """The verse rows of the good files."""
    return checked.where(F.col("reason").isNull()).select(
        "book_number", "chapter", *more, F.inline("verses")).select(
        "book_number", "chapter", "verse", "text", *more)


def parse_payloads(files: DataFrame, policy: str = "fetch") -> DataFrame:
    """``files(book_number, chapter, value)`` - one row per file - to verse rows."""
    return payload_rows(checked_payloads(files.select("book_number", "chapter", "value"), policy))


def named_files(raw: DataFrame, path=None) -> DataFrame:
    """(file, book_number, chapter, value) of whole files read as text, by folders or by name."""
    path = F.col("_metadata.file_path") if path is None else F.col(path)
    place = lambda group: F.coalesce(
        F.regexp_extract(path, PLACE_PATTERN, group).try_cast("int"),
        F.regexp_extract(path, NAME_PATTERN, group).try_cast("int"))
    return raw.select(path.alias("file"), place(1).alias("book_number"),
                      place(2).alias("chapter"), "value")


def listed_files(listed: DataFrame) -> DataFrame:
    """``named_files`` of a listing."""
    return named_files(read_files(listed), "file")


def _landed(spark: SparkSession, path: str, listed: DataFrame | None) -> DataFrame:
    # folders below are looked through, and their names are not taken for partitions
    if listed is not None:
        return listed_files(listed)
    return named_files(spark.read.option("recursiveFileLookup", True).text(path, wholetext=True))


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason) of the files of no bytes below ``path``. Spark's sources, streams included,
    pass over them."""
    return _empty(spark, path, list_files(spark, path))


def _empty(spark: SparkSession, path: str, listed: DataFrame | None) -> DataFrame:
    if listed is not None:
        return listed.where((F.col("size") == 0) & ~F.regexp_extract("place", "[^/]*$", 0).rlike(
            "^[_.]")).select("file", F.lit(EMPTY).alias("reason"))
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    # Plain listings: the located ones of ``listFiles`` ask for every file's owner and mode, on a
    # local disk by a process of its own. A level of folders is listed by several threads.
    def below(folder):
        folders, empty = [], []
        for f in system.listStatus(folder):
            if f.isDirectory():
                folders.append(f.getPath())
            elif f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")):
                empty.append((f.getPath().toString(), EMPTY))
        return folders, empty

    found, level = [], [s.getPath() for s in system.globStatus(top) or []]
    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        while level:
            lists = list(pool.map(below, level))
            level = [f for folders, _ in lists for f in folders]
            found += [row for _, empty in lists for row in empty]
    return spark.createDataFrame(found, "file string, reason string")


def read_payloads(spark: SparkSession, path: str, policy: str = "fetch") -> DataFrame:
    """Read landed payload files (each file is one bounded chapter)."""
    return payload_rows(checked_payloads(_landed(spark, path, list_files(spark, path)), policy))


def quarantined_payloads(spark: SparkSession, path: str, policy: str = "fetch") -> DataFrame:
    """(file, reason) of the landed files of which ``read_payloads`` returns nothing."""
    listed = list_files(spark, path)
    return checked_payloads(_landed(spark, path, listed), policy).where(
        F.col("reason").isNotNull()).select("file", "reason").union(_empty(spark, path, listed))


def unnamed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The files in ``path`` whose name is not ``{book_number}_{chapter}.json``."""
    name = F.col("_metadata.file_name")
    return spark.read.format("binaryFile").load(path).select(name.alias("file")).filter(
        ~F.regexp_like("file", F.lit(NAME_PATTERN))).distinct()


def write_payloads(units: DataFrame, path: str) -> None:
    """Land (book_number, chapter, verse, text) rows as one JSON list per chapter,
    in ``book_number=N/chapter=M`` folders (a chapter is one bounded group)."""
    doc = (units.groupBy("book_number", "chapter")
           .agg(F.to_json(F.array_sort(F.collect_list(F.struct("verse", "text"))))
                .alias("value")))
    write_files(doc, path, ["book_number", "chapter"], "value")
