"""Inner joins of two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.joins import MICROS, bucket, buckets_touched
from weirflow.streaming.stateful import late_tagged


def _equal(on: Sequence[str]):
    condition = F.col(f"l.{on[0]}") == F.col(f"r.{on[0]}")
    for name in on[1:]:
        condition = condition & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    return condition


def _columns(left: DataFrame, right: DataFrame, on: Sequence[str]):
    return [F.col(f"l.{c}") for c in left.columns] + [F.col(f"r.{c}") for c in right.columns if c not in on]


def connect_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Pairs with equal keys. Both sides are kept in state for good, as the operator requires;
    use :func:`interval_join` where a time bound can be given, so that old rows leave the state."""
    return left.alias("l").join(right.alias("r"), _equal(on), "inner").select(*_columns(left, right, on))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    before_seconds: float,
    after_seconds: float,
) -> DataFrame:
    """Pairs with ``right_ts`` in ``[left_ts - before, left_ts + after]``.

    With watermarks on both sides (``withWatermark``) the bounds let Spark drop old state. As in
    the batch form, time buckets in the key spread a hot key over the state partitions.
    """
    before_us, after_us = round(before_seconds * MICROS), round(after_seconds * MICROS)
    touched = buckets_touched(F.unix_micros(left_ts), before_us, after_us)
    a = left.withColumn("_bucket", F.explode(touched))
    b = right.withColumn("_bucket", bucket(F.unix_micros(right_ts), max(before_us + after_us, 1)))
    lag, lead = (f"make_dt_interval(0, 0, 0, {us / MICROS})" for us in (before_us, after_us))
    condition = _equal([*on, "_bucket"]) & F.expr(
        f"r.{right_ts} >= l.{left_ts} - {lag} AND r.{right_ts} <= l.{left_ts} + {lead}"
    )
    return a.alias("l").join(b.alias("r"), condition, "inner").select(*_columns(left, right, on))


def window_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """Pairs with equal keys in the same tumbling window of two watermarked streams.

    A joined row may carry a single event-time column, so each side keeps the window and its
    exact time as microseconds (``<ts>_us``).
    """

    def side(df: DataFrame, ts: str) -> DataFrame:
        others = [c for c in df.columns if c != ts]
        return df.select(F.window(ts, size).alias("window"), F.unix_micros(ts).alias(f"{ts}_us"), *others)

    a, b = side(left, left_ts), side(right, right_ts)
    return connect_join(a, b, ["window", *on])


def tagged_inputs(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, left_delay: str, right_delay: str
) -> DataFrame:
    """Both inputs of an interval join as one stream, each row tagged ``side`` and ``late``.

    The watermark is the lesser of the two inputs' (Spark's policy for several watermarks), and a
    row below it on arrival is late. Route the rows by ``side`` and ``late`` to outputs of their
    own (:func:`weirflow.sinks.routed.start_routed_sink`) and join the ones on time. The rows of
    each side are in the struct column ``left`` or ``right``.
    """

    def side(df: DataFrame, ts: str, delay: str, name: str) -> DataFrame:
        row = F.struct(*df.columns)
        marked = df.withWatermark(ts, delay).withColumns({"_row": row, "_ms": F.unix_millis(ts)})
        return marked.select(*on, F.lit(name).alias("side"), F.col("_ms").alias("ts_ms"), F.col("_row").alias(name))

    both = side(left, left_ts, left_delay, "left").unionByName(
        side(right, right_ts, right_delay, "right"), allowMissingColumns=True
    )
    return late_tagged(both, on, "ts_ms")
