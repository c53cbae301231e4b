"""Written intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpuslink.session import scratch_path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The same rows, written once as Parquet and read back: a lineage cut that every
    executor can reread. An empty table keeps its columns."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
