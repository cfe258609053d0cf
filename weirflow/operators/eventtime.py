"""Watermarks, late data and timers over rows that carry an arrival batch, in batch form.

The watermark moves between arrival batches: rows of batch ``b`` see ``wm_in``, the value left by
the batches before it. All values are epoch milliseconds (bigint), with
``wm = max_ts - delay - 1``; a window ``[start, end)`` is complete once ``end - 1 <= wm``.

A watermark trace has one row per batch. It is aggregated from the rows and written once before
anything is ordered or joined by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.times import floor_to, widened
from weirflow.operators.joins import interval_join
from weirflow.operators.running import running, running_min
from weirflow.session import broadcast_if_small, materialise

ON_TIME, REFIRED, DROPPED = "on_time", "refired", "dropped"


def _before(order: str, *keys: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _so_far(order: str, *keys: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def watermark_trace(df: DataFrame, batch: str, ts_ms: str, delay_ms: int) -> DataFrame:
    """Per arrival batch: rows, largest event time, watermark before (``wm_in``) and after it."""
    per_batch = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n"), F.max(ts_ms).alias("max_ts_ms"))
    return materialise(
        per_batch.withColumns(
            {
                "wm_in": F.max("max_ts_ms").over(_before(batch)) - delay_ms - 1,
                "wm_out": F.max("max_ts_ms").over(_so_far(batch)) - delay_ms - 1,
            }
        )
    )


def source_watermarks(
    df: DataFrame, source: str, batch: str, ts_ms: str, delay_ms: int, idle_batches: int
) -> DataFrame:
    """Watermark of an operator fed by several sources: the least of the sources that are not idle.

    A source is idle from its ``idle_batches``-th batch without rows until its next row. Idle
    sources do not hold the watermark back, and it never moves backwards.
    """
    per_source = df.groupBy(source, batch).agg(F.max(ts_ms).alias("max_ts_ms"))
    marks = per_source.withColumns(
        {
            "_next": F.lead(batch).over(Window.partitionBy(source).orderBy(batch)),
            "wm_source": F.max("max_ts_ms").over(_so_far(batch, source)) - delay_ms - 1,
        }
    )
    last_active = F.least(F.col("_next") - 1, F.col(batch) + idle_batches - 1)
    active = marks.select("wm_source", F.explode(F.sequence(F.col(batch), last_active)).alias(batch))
    least = active.groupBy(batch).agg(
        F.count(F.lit(1)).alias("active_sources"), F.min("wm_source").alias("least_wm")
    )
    return least.select(batch, "active_sources", F.max("least_wm").over(_so_far(batch)).alias("wm"))


def joint_watermark(left: DataFrame, right: DataFrame, batch: str, ts_ms: str, delay_ms: int) -> DataFrame:
    """Watermark before each batch of a two-input operator: the lesser of both, none until both have one."""
    tagged = left.select(batch, F.col(ts_ms).alias("_l"), F.lit(None).cast("bigint").alias("_r")).unionByName(
        right.select(batch, F.lit(None).cast("bigint").alias("_l"), F.col(ts_ms).alias("_r"))
    )
    per_batch = tagged.groupBy(batch).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    seen_left, seen_right = F.max("_l").over(_before(batch)), F.max("_r").over(_before(batch))
    both = F.when(seen_left.isNotNull() & seen_right.isNotNull(), F.least(seen_left, seen_right))
    return materialise(per_batch.select(batch, (both - delay_ms - 1).alias("wm_in")))


def with_watermark(df: DataFrame, trace: DataFrame, batch: str) -> DataFrame:
    """Each row with the watermark that its batch sees on arrival (null: none yet)."""
    return df.join(broadcast_if_small(trace.select(batch, "wm_in")), batch, "left")


def late_split(
    df: DataFrame, trace: DataFrame, batch: str, ts_ms: str, size_ms: int, lateness_ms: int = 0
) -> DataFrame:
    """Tag each row: on time, late but within the allowed lateness, or dropped to the late output."""
    closes = F.col("window_end_ms") - 1
    watermark = F.col("wm_in")
    status = (
        F.when(watermark.isNull() | (closes > watermark), ON_TIME)
        .when(closes + lateness_ms > watermark, REFIRED)
        .otherwise(DROPPED)
    )
    placed = df.withColumn("window_end_ms", floor_to(F.col(ts_ms), size_ms) + size_ms)
    return with_watermark(placed, trace, batch).withColumn("status", status)


def first_batch_reaching(
    times: DataFrame, at_ms: str, trace: DataFrame, batch: str, flush_after_ms: int | None = None
) -> DataFrame:
    """For each distinct ``at_ms`` of ``times``: the first batch after which ``wm >= at_ms``.

    Times and batches are put on one descending time line and the smallest batch met so far is
    carried along it. Null where no batch gets that far; with ``flush_after_ms`` the end of the
    input counts as batch ``last + 1`` and reaches all times up to that long after the last row.
    """
    marks = trace.select(F.col("wm_out").alias("_at"), F.col(batch).cast("bigint").alias("_batch"))
    if flush_after_ms is not None:
        end = trace.agg(
            (F.max("max_ts_ms") + flush_after_ms).alias("_at"), (F.max(batch) + 1).cast("bigint").alias("_batch")
        )
        marks = marks.unionByName(end)
    line = (
        times.select(F.col(at_ms).alias("_at"))
        .distinct()
        .select("_at", F.lit(1).alias("_side"), F.lit(None).cast("bigint").alias("_batch"))
        .unionByName(marks.withColumn("_side", F.lit(0)))
        .withColumns({"_all": F.lit(0), "_down": -F.col("_at")})
    )
    reached = running(materialise(line), ["_all"], ["_down", "_side"], [running_min("fire_batch", F.col("_batch"))])
    return materialise(reached.where(F.col("_side") == 1).select(F.col("_at").alias(at_ms), "fire_batch"))


def allowed_lateness(
    df: DataFrame,
    keys: Sequence[str],
    trace: DataFrame,
    batch: str,
    ts_ms: str,
    size_ms: int,
    lateness_ms: int,
    value: str,
) -> DataFrame:
    """Window results with revisions: the first firing, then one per batch with late records.

    Windows still open at the end of the input fire in batch ``last + 1``. Rows beyond the
    lateness are left out (see :func:`late_split`).
    """
    rows = late_split(df, trace, batch, ts_ms, size_ms, lateness_ms).where(F.col("status") != DROPPED)
    per_arrival = rows.groupBy(*keys, "window_end_ms", "status", batch).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(widened(df, value)).alias("_sum")
    )
    closing = df.select((floor_to(F.col(ts_ms), size_ms) + size_ms - 1).alias("closes_ms"))
    fired = broadcast_if_small(first_batch_reaching(closing, "closes_ms", trace, batch, size_ms))
    timed = per_arrival.withColumn("closes_ms", F.col("window_end_ms") - 1).join(fired, "closes_ms", "left")
    firing = F.when(F.col("status") == ON_TIME, F.col("fire_batch")).otherwise(F.col(batch).cast("bigint"))
    firings = (
        timed.withColumn("firing_batch", firing)
        .groupBy(*keys, "window_end_ms", "firing_batch")
        .agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
    )
    # One row per firing of a window: a handful, bounded by the batches within the lateness.
    along = _so_far("firing_batch", *keys, "window_end_ms")
    return firings.select(
        *keys,
        "window_end_ms",
        "firing_batch",
        (F.row_number().over(along) - 1).alias("revision"),
        F.sum("_n").over(along).alias("n"),
        F.sum("_sum").over(along).alias(f"sum_{value}"),
    )


def split_late(df: DataFrame, watermarks: DataFrame, batch: str, ts_ms: str) -> tuple[DataFrame, DataFrame]:
    """Rows on time and rows late (event time below the watermark) for a join input."""
    seen = with_watermark(df, watermarks, batch)
    late = F.coalesce(F.col(ts_ms) < F.col("wm_in"), F.lit(False))
    return seen.where(~late), seen.where(late)


def interval_join_with_late(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    before_seconds: float,
    after_seconds: float,
    batch: str,
    ts_ms: str,
    delay_ms: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interval join of the rows on time, and the late rows of the left and of the right side."""
    watermarks = joint_watermark(left, right, batch, ts_ms, delay_ms)
    left_ok, left_late = split_late(left, watermarks, batch, ts_ms)
    right_ok, right_late = split_late(right, watermarks, batch, ts_ms)
    a, b = left_ok.drop(batch, ts_ms, "wm_in"), right_ok.drop(batch, ts_ms, "wm_in")
    pairs = interval_join(a, b, on, left_ts, right_ts, before_seconds, after_seconds)
    return pairs, left_late, right_late


def event_timers(df: DataFrame, keys: Sequence[str], at_ms: str, trace: DataFrame, batch: str) -> DataFrame:
    """Event-time timers: one per distinct key and time, with the batch in which it fires."""
    timers = df.select(*keys, at_ms).distinct()
    fired = broadcast_if_small(first_batch_reaching(df, at_ms, trace, batch))
    return timers.join(fired, at_ms, "left")
