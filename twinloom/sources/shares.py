"""Shares, the messages of feeds: sources and sinks, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_shares(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_shares(
    spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """Shares as they arrive in ``path``.

    Parquet keeps ``timestamp_ntz`` columns; a stream's time must be a ``timestamp``, so
    ``occurred_at`` is turned into one.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))


def write_shares(shares: DataFrame, path: str) -> None:
    """Append shares to the table of feeds, one folder per feed id.

    The rebalance keeps a busy feed in many files and quiet feeds in few.
    """
    shares.hint("rebalance", "feed_id").write.mode("append").partitionBy("feed_id").parquet(path)
