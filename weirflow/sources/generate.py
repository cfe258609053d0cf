"""Generated sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.scalars import labelled_number


def numbers(spark: SparkSession, count: int, partitions: int | None = None) -> DataFrame:
    """``Number: 0`` .. ``Number: count-1``, generated in contiguous ranges by parallel tasks."""
    return spark.range(0, count, 1, partitions).select(labelled_number(F.col("id")).alias("value"))


def number_stream(spark: SparkSession, rows_per_second: int = 10, partitions: int = 2) -> DataFrame:
    """Unbounded rate-limited sequence of the same records."""
    ticks = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )
    return ticks.select("timestamp", labelled_number(F.col("value")).alias("value"))


def number_batches(spark: SparkSession, rows_per_batch: int = 10, partitions: int = 2) -> DataFrame:
    """The same sequence with a fixed number of rows per micro-batch."""
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("numPartitions", partitions)
        .load()
    )
    return ticks.select("timestamp", labelled_number(F.col("value")).alias("value"))
