"""Watermarks, late data, keyed state and timers."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import eventtime, rolling, state
from weirflow.plans.registry import query
from weirflow.plans.views import (
    DELAY_MS,
    LATENESS_MS,
    SENSOR_SQL,
    STATUS_SQL,
    WINDOW_MS,
    arrivals,
    of_kind,
    sensor,
)

KEY, ORDER = ["id"], ["ts", "seq"]
BY_KEY = "PARTITION BY id ORDER BY ts, seq"
RUN = f"{BY_KEY} ROWS UNBOUNDED PRECEDING"
JUMP = 10
TTL_SECONDS = 6 * 3600


def _trace(rows):
    return eventtime.watermark_trace(rows, "batch", "ts_ms", DELAY_MS)


@query("late_split", f"WITH {STATUS_SQL} SELECT id, seq, batch, window_end_ms, wm_in, status FROM tagged")
def late_split(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    out = eventtime.late_split(rows, _trace(rows), "batch", "ts_ms", WINDOW_MS, LATENESS_MS)
    return out.select("id", "seq", "batch", "window_end_ms", "wm_in", "status")


@query(
    "allowed_lateness",
    f"""WITH {STATUS_SQL}, closes AS (SELECT DISTINCT window_end_ms FROM tagged), fired AS (
      SELECT c.window_end_ms, coalesce(min(t.batch), (SELECT max(batch) + 1 FROM trace)) AS fire_batch
      FROM closes c LEFT JOIN trace t ON t.wm_out >= c.window_end_ms - 1 GROUP BY 1
    ), firings AS (
      SELECT g.id, g.window_end_ms, CASE WHEN g.status = 'on_time' THEN f.fire_batch ELSE g.batch END AS firing_batch,
             count(*) AS n, sum(vc) AS s
      FROM tagged g JOIN fired f ON g.window_end_ms = f.window_end_ms WHERE g.status <> 'dropped' GROUP BY ALL
    )
    SELECT id, window_end_ms, firing_batch, CAST(row_number() OVER w - 1 AS INTEGER) AS revision,
           CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(s) OVER w AS BIGINT) AS sum_vc
    FROM firings WINDOW w AS (PARTITION BY id, window_end_ms ORDER BY firing_batch ROWS UNBOUNDED PRECEDING)""",
)
def allowed_lateness(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    return eventtime.allowed_lateness(rows, KEY, _trace(rows), "batch", "ts_ms", WINDOW_MS, LATENESS_MS, "vc")


@query(
    "state_value_diff",
    f"""WITH {SENSOR_SQL}, held AS (SELECT *, coalesce(lag(vc) OVER ({BY_KEY}), 0) AS prev_vc FROM sensor)
    SELECT id, seq, vc, prev_vc FROM held WHERE abs(vc - prev_vc) > {JUMP}""",
)
def state_value_diff(spark, sf_dir):
    return state.jumps(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc", JUMP).select("id", "seq", "vc", "prev_vc")


@query(
    "state_top3",
    f"""WITH {SENSOR_SQL}, held AS (SELECT *, list(vc) OVER ({RUN}) AS held FROM sensor)
    SELECT id, seq, array_to_string(list_reverse_sort(held)[1:3], ',') AS top FROM held""",
)
def state_top3(spark, sf_dir):
    out = state.top_so_far(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc", 3)
    as_text = F.concat_ws(",", F.transform("top", lambda v: v.cast("string")))
    return out.select("id", "seq", as_text.alias("top"))


@query(
    "state_map_counts",
    f"""WITH {SENSOR_SQL} SELECT id, seq, vc, row_number() OVER (PARTITION BY id, vc ORDER BY ts, seq) AS n FROM sensor""",
)
def state_map_counts(spark, sf_dir):
    out = state.value_counts_so_far(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc")
    return out.select("id", "seq", "vc", "n")


@query("state_map_final", f"WITH {SENSOR_SQL} SELECT id, vc, count(*) AS n FROM sensor GROUP BY id, vc")
def state_map_final(spark, sf_dir):
    return state.value_counts(sensor(spark, sf_dir), KEY, "vc")


@query("state_running_sum", f"WITH {SENSOR_SQL} SELECT id, seq, CAST(sum(vc) OVER ({RUN}) AS BIGINT) AS sum_vc FROM sensor")
def state_running_sum(spark, sf_dir):
    return rolling.rolling_sum(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc").select("id", "seq", "sum_vc")


@query(
    "state_running_avg",
    f"WITH {SENSOR_SQL} SELECT id, seq, CAST(sum(vc) OVER ({RUN}) AS DOUBLE) / count(*) OVER ({RUN}) AS avg_vc FROM sensor",
)
def state_running_avg(spark, sf_dir):
    return rolling.rolling_average(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc").select("id", "seq", "avg_vc")


@query(
    "state_ttl_last",
    f"""WITH {SENSOR_SQL}, held AS (
      SELECT *, lag(vc) OVER ({BY_KEY}) AS p, lag(ts) OVER ({BY_KEY}) AS pt FROM sensor
    ) SELECT id, seq, CASE WHEN epoch_us(ts) - epoch_us(pt) < {TTL_SECONDS}000000 THEN p ELSE 0 END AS last_vc FROM held""",
)
def state_ttl_last(spark, sf_dir):
    out = state.last_within(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc", TTL_SECONDS)
    return out.select("id", "seq", "last_vc")


@query("running_counter", f"WITH {SENSOR_SQL} SELECT id, seq, row_number() OVER ({BY_KEY}) - 1 AS counter FROM sensor")
def running_counter(spark, sf_dir):
    return state.record_counter(sensor(spark, sf_dir).drop("kind"), KEY, ORDER).select("id", "seq", "counter")


@query(
    "broadcast_threshold",
    f"""WITH {SENSOR_SQL}, control AS (SELECT ts AS from_ts, vc AS threshold FROM sensor WHERE kind = 'signup'),
    held AS (
      SELECT s.id, s.seq, s.vc, coalesce(c.threshold, 0) AS threshold
      FROM sensor s ASOF LEFT JOIN control c ON s.ts >= c.from_ts
    ) SELECT * FROM held WHERE vc > threshold""",
)
def broadcast_threshold(spark, sf_dir):
    """Each signup sets the threshold that all later readings are compared with."""
    readings = sensor(spark, sf_dir)
    control = of_kind(readings, "signup").select(
        F.col("ts").alias("from_ts"), F.col("seq").alias("from_seq"), F.col("vc").alias("threshold")
    )
    data = readings.select("id", "ts", "seq", "vc")
    out = state.above_threshold(data, control, "ts", "vc", "from_ts", "from_seq")
    return out.select("id", "seq", "vc", "threshold")
