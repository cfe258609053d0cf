"""Joins of two inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import joins
from weirflow.operators.eventtime import interval_join_with_late
from weirflow.plans.registry import query
from weirflow.plans.views import ARRIVALS_SQL, DELAY_MS, SENSOR_SQL, arrivals, bucket_sql, of_kind, sensor, table, window_sql

HOUR = 3600
BOUND_SECONDS = 2 * HOUR


@query(
    "connect_join",
    """SELECT o_orderkey AS orderkey, o_custkey AS custkey, l_linenumber AS linenumber, l_partkey AS partkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def connect_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
    )
    return joins.connect_join(orders, lines, ["orderkey"])


def _sides(readings, *extra):
    left = of_kind(readings, "click").select("id", F.col("ts").alias("left_ts"), F.col("seq").alias("left_seq"), *extra)
    right = of_kind(readings, "purchase").select(
        "id", F.col("ts").alias("right_ts"), F.col("seq").alias("right_seq"), *extra
    )
    return left, right


@query(
    "window_join",
    f"""WITH {SENSOR_SQL} SELECT a.id, {window_sql(bucket_sql("a.ts", HOUR), HOUR)}, a.seq AS left_seq, b.seq AS right_seq
    FROM sensor a JOIN sensor b ON a.id = b.id AND {bucket_sql("a.ts", HOUR)} = {bucket_sql("b.ts", HOUR)}
    WHERE a.kind = 'click' AND b.kind = 'purchase'""",
)
def window_join(spark, sf_dir):
    left, right = _sides(sensor(spark, sf_dir))
    out = joins.window_join(left, right, ["id"], "left_ts", "right_ts", "1 hour")
    return out.select("id", "window_start", "window_end", "left_seq", "right_seq")


@query(
    "interval_join",
    f"""WITH {SENSOR_SQL} SELECT a.id, a.ts AS left_ts, a.seq AS left_seq, b.ts AS right_ts, b.seq AS right_seq
    FROM sensor a JOIN sensor b ON a.id = b.id
     AND b.ts BETWEEN a.ts - INTERVAL {BOUND_SECONDS} SECOND AND a.ts + INTERVAL {BOUND_SECONDS} SECOND
    WHERE a.kind = 'click' AND b.kind = 'purchase'""",
)
def interval_join(spark, sf_dir):
    left, right = _sides(sensor(spark, sf_dir))
    return joins.interval_join(left, right, ["id"], "left_ts", "right_ts", BOUND_SECONDS, BOUND_SECONDS)


_LATE_SQL = f"""WITH {ARRIVALS_SQL}, sides AS (SELECT * FROM arrivals WHERE kind IN ('click', 'purchase')),
per_batch AS (
  SELECT batch, max(CASE WHEN kind = 'click' THEN ts_ms END) AS l, max(CASE WHEN kind = 'purchase' THEN ts_ms END) AS r
  FROM sides GROUP BY batch
), seen AS (
  SELECT batch, max(l) OVER w AS l, max(r) OVER w AS r FROM per_batch
  WINDOW w AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marks AS (
  SELECT batch, CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN least(l, r) - {DELAY_MS} - 1 END AS wm_in FROM seen
), flagged AS (
  SELECT s.*, m.wm_in, coalesce(s.ts_ms < m.wm_in, false) AS late FROM sides s JOIN marks m ON s.batch = m.batch
)"""


def _late_join(spark, sf_dir):
    left, right = _sides(arrivals(spark, sf_dir), "batch", "ts_ms")
    return interval_join_with_late(
        left, right, ["id"], "left_ts", "right_ts", BOUND_SECONDS, BOUND_SECONDS, "batch", "ts_ms", DELAY_MS
    )


@query(
    "interval_join_on_time",
    f"""{_LATE_SQL} SELECT a.id, a.seq AS left_seq, b.seq AS right_seq FROM flagged a JOIN flagged b ON a.id = b.id
     AND b.ts BETWEEN a.ts - INTERVAL {BOUND_SECONDS} SECOND AND a.ts + INTERVAL {BOUND_SECONDS} SECOND
    WHERE a.kind = 'click' AND b.kind = 'purchase' AND NOT a.late AND NOT b.late""",
)
def interval_join_on_time(spark, sf_dir):
    return _late_join(spark, sf_dir)[0].select("id", "left_seq", "right_seq")


@query(
    "interval_join_late_left",
    f"{_LATE_SQL} SELECT id, seq AS left_seq, ts_ms, wm_in FROM flagged WHERE kind = 'click' AND late",
)
def interval_join_late_left(spark, sf_dir):
    return _late_join(spark, sf_dir)[1].select("id", "left_seq", "ts_ms", "wm_in")


@query(
    "interval_join_late_right",
    f"{_LATE_SQL} SELECT id, seq AS right_seq, ts_ms, wm_in FROM flagged WHERE kind = 'purchase' AND late",
)
def interval_join_late_right(spark, sf_dir):
    return _late_join(spark, sf_dir)[2].select("id", "right_seq", "ts_ms", "wm_in")
