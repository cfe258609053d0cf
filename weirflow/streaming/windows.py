"""Windowed aggregation of streams, by event time and by processing time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.windows import flatten_window


def monotonous(stream: DataFrame, ts: str) -> DataFrame:
    """Watermark of a source whose event times never go back."""
    return stream.withWatermark(ts, "0 seconds")


def out_of_order(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark that trails the largest event time by ``delay``."""
    return stream.withWatermark(ts, delay)


def _aggregate(stream: DataFrame, keys: Sequence[str], window: Column, aggregates: dict[str, Column]) -> DataFrame:
    grouped = stream.groupBy(*keys, window.alias("window")).agg(*[a.alias(n) for n, a in aggregates.items()])
    return flatten_window(grouped)


def event_windows(
    stream: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str | None = None, **aggregates: Column
) -> DataFrame:
    """Tumbling or sliding windows of a watermarked stream; append mode emits each window once."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return _aggregate(stream, keys, window, aggregates)


def event_sessions(
    stream: DataFrame, keys: Sequence[str], ts: str, gap: str | Column, **aggregates: Column
) -> DataFrame:
    """Sessions of a watermarked stream; ``gap`` is a duration or a duration text per record."""
    return _aggregate(stream, keys, F.session_window(ts, gap), aggregates)


def gap_seconds(seconds: Column) -> Column:
    """A per-record session gap."""
    return F.concat(seconds.cast("string"), F.lit(" seconds"))


def with_processing_time(stream: DataFrame, name: str = "pt", clock: Column | None = None) -> DataFrame:
    """Stamp each row with its time of processing and use that as the watermark column.

    ``clock`` takes the place of the machine's (:func:`weirflow.sources.replay.paced_stream` has one that is the same in every
    run). The stream must not have another watermark.
    """
    return stream.withColumn(name, F.current_timestamp() if clock is None else clock).withWatermark(name, "0 seconds")


def processing_windows(
    stream: DataFrame, keys: Sequence[str], size: str, slide: str | None = None, clock: Column | None = None, **aggregates: Column
) -> DataFrame:
    return event_windows(with_processing_time(stream, clock=clock), keys, "pt", size, slide, **aggregates)


def processing_sessions(
    stream: DataFrame, keys: Sequence[str], gap: str | Column, clock: Column | None = None, **aggregates: Column
) -> DataFrame:
    return event_sessions(with_processing_time(stream, clock=clock), keys, "pt", gap, **aggregates)
