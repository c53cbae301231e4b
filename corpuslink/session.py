"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins from runtime sizes and splits
# skewed shuffle partitions; the UI stays off (no server is started).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, app: str = "corpuslink",
              shuffle_partitions: int | None = None, checkpoint: str | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    ``checkpoint`` names the shared folder for written intermediate tables, unless
    ``spark.checkpoint.dir`` is set already.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint:
        conf["spark.checkpoint.dir"] = checkpoint
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when
    it is unset (local tests), never on a cluster.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="corpuslink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, below the shared one."""
    return os.path.join(checkpoint_dir(spark), f"run-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A place in this application's folder for a written table."""
    return os.path.join(run_folder(spark), name)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. DataFrames of the library read them, so
    call it when the results are written; the folders of applications that ended without it
    (``run-<application id>``) may be deleted at any time."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The same rows, written once to the shared folder and read back: a lineage cut that every
    executor can read again. ``codec``: Parquet's, if not the session's."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
