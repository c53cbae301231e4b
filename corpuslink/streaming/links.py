"""Link statements imported into an edge table that is filled already (O-32, O-33), batch by batch.

A batch keeps the edges it adds in ``edges/batch=<id>`` and its accounting in
``reports/batch=<id>``. An edge that an earlier batch has is ignored (first wins across batches) and credited
there; earlier means a lower batch id, so a batch that runs again compares with the same
edges, gives the same rows and replaces its own folders only. Batches whose files follow each
other in name order give together what one import of all files gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.links import _import_report, import_links
from corpuslink.sources.linkdump import parse_link_lines
from corpuslink.streaming.ingest import BATCH, _read

EDGES = f"from_id long, to_id long, votes long, {BATCH} long"
REPORT = ("file string, lines_processed long, imported long, skipped long, unparsed long, "
          f"{BATCH} long")


def read_edges(spark: SparkSession, target: str) -> DataFrame:
    """(from_id, to_id, votes, batch): the table, one row an edge."""
    return _read(spark, f"{target}/edges", EDGES)


def read_report(spark: SparkSession, target: str) -> DataFrame:
    """The accounting per file over all batches."""
    return _read(spark, f"{target}/reports", REPORT).groupBy("file").agg(*[
        F.sum(c).alias(c) for c in ("lines_processed", "imported", "skipped", "unparsed")])


def import_batch(parsed: DataFrame, batch_id: int, target: str, from_units: DataFrame,
                 to_units: DataFrame | None = None) -> None:
    """Insert one batch of parsed statements; the same batch again replaces itself."""
    spark = parsed.sparkSession
    found = import_links(parsed, from_units, to_units)
    earlier = read_edges(spark, target).where(F.col(BATCH) < batch_id)
    new = found["winners"].join(earlier.select("from_id", "to_id"), ["from_id", "to_id"], "left_anti")
    new.select("from_id", "to_id", F.col("votes").cast("long").alias("votes"), "file").write.mode(
        "overwrite").parquet(f"{target}/edges/{BATCH}={batch_id}")
    added = spark.read.parquet(f"{target}/edges/{BATCH}={batch_id}")
    _import_report(found["rows"], added).write.mode("overwrite").parquet(
        f"{target}/reports/{BATCH}={batch_id}")


def stream_links(spark: SparkSession, landing: str, target: str, checkpoint: str,
                 from_units: DataFrame, to_units: DataFrame | None = None, max_files: int = 1000,
                 available_now: bool = True):
    """O-91 for link dumps: files that land below ``landing`` into the edge table."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(landing)
    lines = raw.select("value", F.col("_metadata.file_name").alias("file"),
                       F.col("_metadata.file_block_start").alias("_block"))

    def each_batch(df: DataFrame, batch_id: int) -> None:
        numbered = df.select("file", F.struct("file", "_block", F.monotonically_increasing_id().alias(
            "_row")).alias("line_no"), "value")
        import_batch(parse_link_lines(numbered), batch_id, target, from_units, to_units)

    w = lines.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
