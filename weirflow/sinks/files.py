"""Text file sinks. A checkpoint and the sink's own manifest make each batch appear once.

Files roll by time and records (:func:`start_text_sink`) or by time and bytes (:func:`start_rolled_sink`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from weirflow.operators.running import SLICE_ROWS, running, running_sum
from weirflow.session import materialise

# The bucket directory pattern and the roll-over settings.
BUCKET_FORMAT = "yyyy-MM-dd HH"
ROLL_SECONDS = 10
ROLL_BYTES = 1024


def with_hour_bucket(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Add ``bucket``, the hour of ``ts`` (by default the hour of processing) as a directory name."""
    moment = F.current_timestamp() if ts is None else ts
    return df.withColumn("bucket", F.date_format(moment, BUCKET_FORMAT))


def start_text_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    roll_seconds: int | None = ROLL_SECONDS,
    max_records: int | None = None,
    bucketed: bool = True,
) -> StreamingQuery:
    """Append the string column ``value`` to text files, in hour-of-processing directories.

    Files are closed at each trigger, so the trigger interval is the time roll-over; ``None``
    processes what is available and stops. Spark limits a file by records, not bytes: pass
    ``max_records`` (:func:`records_per_file` converts a byte size).
    """
    writer = stream.select("value")
    if bucketed:
        writer = with_hour_bucket(writer)
    out = writer.writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint)
    if bucketed:
        out = out.partitionBy("bucket")
    if max_records:
        out = out.option("maxRecordsPerFile", max_records)
    if roll_seconds:
        out = out.trigger(processingTime=f"{roll_seconds} seconds")
    else:
        out = out.trigger(availableNow=True)
    return out.start(path)


def records_per_file(average_line_bytes: int, roll_bytes: int = ROLL_BYTES) -> int:
    return max(1, roll_bytes // max(1, average_line_bytes + 1))


def file_numbers(
    df: DataFrame, value: str, order: Sequence[str], roll_bytes: int = ROLL_BYTES, bucket: Sequence[str] = (), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``df`` with ``file_no`` (from 0 in each bucket) and ``file_bytes``, the bytes of the bucket's lines before it.

    A line goes to the file in whose ``roll_bytes`` it starts, so no file is larger than that by more than one line.
    A line's bytes are those of its text and its line end; a null has an empty line. The sum of bytes is folded along
    ``order`` in slices (:mod:`weirflow.operators.running`), so a bucket of any size is numbered by many tasks. Where
    a line is longer than ``roll_bytes``, numbers are left out.
    """
    group = [*bucket] or ["_all"]
    rows = df if bucket else df.withColumn("_all", F.lit(0))
    length = (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("bigint")
    summed = running(rows, group, order, [running_sum("file_bytes", length, before=True)], slice_rows)
    before = F.coalesce("file_bytes", F.lit(0))
    numbered = summed.withColumn("file_bytes", before).withColumn("file_no", F.floor(F.col("file_bytes") / roll_bytes).cast("bigint"))
    return numbered.drop("_all")


def write_rolled(
    df: DataFrame, path: str, order: Sequence[str], roll_bytes: int = ROLL_BYTES, bucket: str | None = None, slice_rows: int = SLICE_ROWS
) -> None:
    """Write the string column ``value`` to text files of ``roll_bytes`` and less than one more line each.

    With ``bucket``, files of its values are in directories of their own. Each file is one task of its own, with the
    lines along ``order``; the folder is replaced, so a repeated write leaves no second copy. Only the table of
    files is counted before (one row each, dealt by bucket).
    """
    buckets = [bucket] if bucket else []
    numbered = file_numbers(df, "value", order, roll_bytes, buckets, slice_rows)
    # Written once: what numbers the files and what fills them must agree.
    lines = materialise(numbered.select("value", *buckets, "file_no", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]))
    files = lines.select(*buckets, "file_no").distinct()
    per_bucket = files.groupBy(*buckets).agg((F.max("file_no") + 1).alias("_files"))
    firsts = per_bucket.withColumn("_first", F.sum("_files").over(Window.orderBy(*buckets)) - F.col("_files")) if buckets else None
    total = per_bucket.agg(F.sum("_files")).first()[0] or 1
    placed, number = lines, F.col("file_no")
    if buckets:
        first = firsts.select(F.col(bucket).alias("_bucket"), "_first")
        placed = lines.join(first, F.col(bucket).eqNullSafe(F.col("_bucket")))
        number = F.col("file_no") + F.col("_first")
    # Sorted by bucket first, as the writer would else sort by it and lose the order.
    out = placed.repartitionById(int(total), number.cast("int")).sortWithinPartitions(*buckets, *[f"_o{i}" for i in range(len(order))])
    writer = out.select("value", *buckets).write.mode("overwrite")
    (writer.partitionBy(bucket) if bucket else writer).text(path)


def start_rolled_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str],
    roll_bytes: int = ROLL_BYTES,
    roll_seconds: int | None = ROLL_SECONDS,
    bucketed: bool = True,
) -> StreamingQuery:
    """The stream's ``value`` lines in files that roll at each trigger and at ``roll_bytes``, in hour-of-processing directories.

    A micro-batch replaces its own directory ``batch_id=<n>``, so a repeated one is not doubled. ``roll_seconds`` None
    processes what is available and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_hour_bucket(batch) if bucketed else batch
        write_rolled(rows, f"{path}/batch_id={batch_id}", order, roll_bytes, "bucket" if bucketed else None)

    out = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"processingTime": f"{roll_seconds} seconds"} if roll_seconds else {"availableNow": True}
    return out.trigger(**trigger).start()
