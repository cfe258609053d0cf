"""Running a stream over what is available now, with results as a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from weirflow.session import shared_dir


def run_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared folder."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _start(stream: DataFrame, output_mode: str, folder: str, **trigger) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def _written(stream: DataFrame, folder: str) -> DataFrame:
    return stream.sparkSession.read.schema(f"{_ddl(stream)}, batch_id bigint").parquet(f"{folder}/rows")


def run_available(stream: DataFrame, output_mode: str = "append", folder: str | None = None) -> DataFrame:
    """Process all available input and return the written rows with their ``batch_id``.

    Each micro-batch overwrites its own directory, so a retried batch is not doubled. With the
    ``complete`` mode only the last batch is the result; with ``update`` a later batch replaces
    earlier rows of the same key. Give the same ``folder`` again to resume from its checkpoint.
    """
    folder = folder or run_folder(stream.sparkSession)
    _start(stream, output_mode, folder, availableNow=True).awaitTermination()
    return _written(stream, folder)


def run_for(stream: DataFrame, seconds: float, every: str = "500 milliseconds", folder: str | None = None) -> DataFrame:
    """Run for a while, then stop: for streams with processing-time state, which never run dry."""
    folder = folder or run_folder(stream.sparkSession)
    started = _start(stream, "append", folder, processingTime=every)
    try:
        started.awaitTermination(seconds)
    finally:
        started.stop()
    return _written(stream, folder)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def last_per_key(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The result of an ``update`` mode run: of each key the row of the last batch that has it."""
    others = [c for c in written.columns if c not in {*keys, "batch_id"}]
    last = written.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def last_batch(written: DataFrame) -> DataFrame:
    """The result of a ``complete`` mode run."""
    last = written.agg(F.max("batch_id")).first()[0]
    return written.where(F.col("batch_id") == last).drop("batch_id")


def run_to_end(stream: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], folder: str | None = None) -> DataFrame:
    """Run ``build(stream)`` over a bounded stream so that all its windows close.

    After the available input a single far-future row follows in a micro-batch of its own and
    moves the watermark past every real row. The windows of that row (its columns other than
    ``ts`` are null) stay open and are never emitted. ``build`` sets the watermark and must not
    filter that row out, as Spark would then drop it before it reaches the watermark.
    """
    spark = stream.sparkSession
    folder = folder or run_folder(spark)
    marker = [
        (F.lit("9000-01-01 00:00:00") if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in stream.schema
    ]
    end = f"{folder}/end"
    spark.range(0).select(*marker).write.parquet(end)
    built = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(end)))
    run_available(built, "append", folder)
    spark.range(1).select(*marker).write.mode("append").parquet(end)
    return run_available(built, "append", folder)
