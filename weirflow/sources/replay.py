"""A bounded table replayed as a stream in the order of its columns, or at a fixed rate by a clock of its own."""

from __future__ import annotations

import math
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.times import ordinal
from weirflow.operators.running import SLICE_ROWS, running, running_sum


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and a function that makes its path objects."""
    jvm = spark.sparkContext._jvm
    as_path = jvm.org.apache.hadoop.fs.Path
    return as_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), as_path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written; one that isn't there is no error."""
    files, as_path = _files(spark, path)
    files.delete(as_path(path), True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, as_path = _files(spark, path)
    return files.exists(as_path(path))


def publish_in_order(spark: SparkSession, staged: str, folder: str) -> int:
    """Move the part files of ``staged`` to ``folder`` so that a file stream reads them in the order of their numbers.

    Only metadata is touched: a part is renamed, and its time of modification, which file streams go by, is
    set a millisecond after the one before. A store that can't set times has the order of the renames. Returns the
    number of files.
    """
    files, as_path = _files(spark, staged)
    files.mkdirs(as_path(folder))
    found = [status.getPath().getName() for status in files.listStatus(as_path(staged))]
    parts = sorted((int(m[1]), name) for name in found if (m := re.match(r"part-(\d+)-", name)))
    first = int(time.time() * 1000) - len(parts)
    for number, (_, name) in enumerate(parts):
        place = as_path(f"{folder}/slice-{number:09d}.parquet")
        files.rename(as_path(f"{staged}/{name}"), place)
        files.setTimes(place, first + number, -1)
    return len(parts)


def ordered_stream(df: DataFrame, by: str, folder: str, slice_rows: int = 1_000_000) -> DataFrame:
    """A bounded table as a stream in the order of ``by``, however its own files are laid out.

    One range shuffle deals the rows to consecutive slices of about ``slice_rows`` rows; each is one file in
    ``folder`` and one micro-batch. The table is read for the shuffle, whatever the number of slices, and its
    column ``by`` once before for the bounds. Rows of one value are never parted; rows without one come first.
    """
    spark = df.sparkSession
    slices = max(1, math.ceil(df.count() / slice_rows))
    staged = f"{folder.rstrip('/')}-staged-{uuid.uuid4().hex}"
    df.repartitionByRange(slices, ordinal(df, by)).write.parquet(staged)
    publish_in_order(spark, staged, folder)
    delete_folder(spark, staged)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def paced_stream(
    df: DataFrame,
    order: Sequence[str],
    folder: str,
    rows_per_second: int,
    started: int = 0,
    clock: str = "pt",
    slice_rows: int = 1_000_000,
    cut_rows: int = SLICE_ROWS,
) -> DataFrame:
    """A bounded table as a stream that comes in at ``rows_per_second`` along ``order``, with that time in ``clock``.

    The clock starts at ``started`` (epoch seconds) and is told by a row's number, not by the machine, so windows of
    processing time over it have the same result in every run, whatever micro-batches, restarts and
    machines do. Rows are numbered in slices by many tasks. Ties of ``order`` may come in any order: give one without ties.
    """
    counted = running(df.withColumn("_all", F.lit(0)), ["_all"], order, [running_sum("_rn", F.lit(1).cast("bigint"))], cut_rows)
    second = F.floor((F.col("_rn") - 1) / rows_per_second) + started
    return ordered_stream(counted.withColumn(clock, F.timestamp_seconds(second)).drop("_all", "_rn"), clock, folder, slice_rows)
