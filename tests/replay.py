"""Replays lists of rows as a stream, one file and micro-batch per list."""

import os
from pathlib import Path

import pyarrow.parquet as pq


def replay(spark, folder: Path, schema: str, batches: list[list[tuple]]):
    """A stream whose n-th micro-batch holds the n-th list."""
    folder.mkdir(parents=True, exist_ok=True)
    for number, rows in enumerate(batches):
        add_batch(spark, folder, schema, rows, number)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def add_batch(spark, folder: Path, schema: str, rows: list[tuple], number: int) -> None:
    table = spark.createDataFrame(rows, schema).toArrow()
    path = folder / f"batch-{number:04d}.parquet"
    pq.write_table(table, path, coerce_timestamps="us", allow_truncated_timestamps=True)
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def replay_lines(spark, folder: Path, batches: list[list[str]]):
    from weirflow.sources.lines import line_stream

    folder.mkdir(parents=True, exist_ok=True)
    for number, lines in enumerate(batches):
        path = folder / f"batch-{number:04d}.txt"
        path.write_text("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    return line_stream(spark, "text", str(folder), maxFilesPerTrigger=1)
