"""Inner joins of two keyed inputs: equi, same-window and interval.

No side is broadcast by hint: Spark picks a broadcast by the measured size, and AQE splits the
skewed partitions of a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.times import floor_to, ordinal

MICROS = 1_000_000


def connect_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every pair of rows with equal keys, once, whichever side came first."""
    return left.join(right, list(on), "inner")


def window_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """Pairs with equal keys whose event times fall in the same tumbling window."""
    a = left.withColumn("_w", F.window(left_ts, size))
    b = right.withColumn("_w", F.window(right_ts, size))
    starts = F.col("_w.start"), F.col("_w.end")
    a = a.select(*left.columns, starts[0].alias("window_start"), starts[1].alias("window_end"))
    b = b.select(*right.columns, starts[0].alias("window_start"))
    return a.join(b, [*on, "window_start"], "inner")


def within(left_at: Column, right_at: Column, before_us: int, after_us: int) -> Column:
    """``right_at`` lies in ``[left_at - before, left_at + after]``, both ends included."""
    return (right_at >= left_at - before_us) & (right_at <= left_at + after_us)


def bucket(micros: Column, width: int) -> Column:
    """Number of the ``width`` microseconds wide bucket that holds ``micros``."""
    return (floor_to(micros, width) / width).cast("bigint")


def buckets_touched(left_at: Column, before_us: int, after_us: int) -> Column:
    """The one or two buckets, as wide as the interval, that a left row's interval touches."""
    width = max(before_us + after_us, 1)
    return F.sequence(bucket(left_at - before_us, width), bucket(left_at + after_us, width))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    before_seconds: float,
    after_seconds: float,
) -> DataFrame:
    """Pairs with equal keys and ``right_ts`` in ``[left_ts - before, left_ts + after]``.

    The equi-key includes a time bucket as wide as the interval, so a hot key spreads over its
    time range. A left row is listed under the one or two buckets its interval touches and a
    right row under exactly one, hence each pair is met once.
    """
    before_us, after_us = round(before_seconds * MICROS), round(after_seconds * MICROS)
    a = left.withColumn("_left_at", ordinal(left, left_ts))
    a = a.withColumn("_bucket", F.explode(buckets_touched(F.col("_left_at"), before_us, after_us)))
    b = right.withColumn("_right_at", ordinal(right, right_ts))
    b = b.withColumn("_bucket", bucket(F.col("_right_at"), max(before_us + after_us, 1)))
    pairs = a.join(b, [*on, "_bucket"], "inner").where(
        within(F.col("_left_at"), F.col("_right_at"), before_us, after_us)
    )
    return pairs.drop("_bucket", "_left_at", "_right_at")
