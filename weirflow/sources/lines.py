"""Line sources, bounded and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_table(spark: SparkSession, path: str) -> DataFrame:
    """Bounded scan of text files, one row per line, split over tasks by Spark."""
    return spark.read.text(path)


def line_stream(spark: SparkSession, format: str = "text", path: str | None = None, **options) -> DataFrame:
    """Streaming lines from any ``readStream`` format that yields a string ``value`` column.

    For files, ``maxFilesPerTrigger`` and ``pathGlobFilter`` pass through as options. Formats
    such as sockets or message brokers are named by the caller and need their own set-up.
    """
    reader = spark.readStream.format(format).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(stream["value"].cast("string").alias("value"))


def table_stream(spark: SparkSession, path: str, max_bytes: int = 1 << 30) -> DataFrame:
    """A parquet table (one file or a directory of files) as a stream, in the order of its files.

    ``max_bytes`` bounds a micro-batch, however many files the table has. Files are in no order of event
    time: give a watermark a delay of at least what they are apart.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes)
    # A glob is taken for a file as well as for a directory.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
