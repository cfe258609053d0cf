"""Views over the given tables that the queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.times import ntz_micros

# Arrival disorder: each event arrives up to two hours after its event time, in hourly batches.
SPREAD_FACTOR, SPREAD_SECONDS, BATCH_SECONDS = 7919, 7200, 3600

# Late-data settings of the queries.
DELAY_MS = 10 * 60 * 1000
WINDOW_MS = 30 * 60 * 1000
LATENESS_MS = 15 * 60 * 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed readings: id, event time, integer value, arrival order, and the event type as kind."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        "ts",
        F.floor("value").cast("int").alias("vc"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with induced disorder: event time in ms and the arrival batch."""
    us = ntz_micros(F.col("ts"))
    seconds = F.floor(us / 1_000_000)
    arrival = seconds + F.pmod(F.col("seq") * SPREAD_FACTOR, F.lit(SPREAD_SECONDS))
    return sensor(spark, sf_dir).withColumns(
        {"ts_ms": F.floor(us / 1000), "batch": F.floor(arrival / BATCH_SECONDS)}
    )


def of_kind(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("kind") == kind)


SENSOR_SQL = """sensor AS (
  SELECT user_id AS id, ts, CAST(floor(value) AS INTEGER) AS vc, event_id AS seq, event_type AS kind FROM events
)"""

ARRIVALS_SQL = f"""{SENSOR_SQL}, arrivals AS (
  SELECT *, epoch_us(ts) // 1000 AS ts_ms,
         (epoch_us(ts) // 1000000 + (seq * {SPREAD_FACTOR}) % {SPREAD_SECONDS}) // {BATCH_SECONDS} AS batch
  FROM sensor
)"""

TRACE_SQL = f"""{ARRIVALS_SQL}, per_batch AS (
  SELECT batch, count(*) AS n, max(ts_ms) AS max_ts_ms FROM arrivals GROUP BY batch
), trace AS (
  SELECT batch, n, max_ts_ms,
         max(max_ts_ms) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_MS} - 1 AS wm_in,
         max(max_ts_ms) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) - {DELAY_MS} - 1 AS wm_out
  FROM per_batch
)"""

STATUS_SQL = f"""{TRACE_SQL}, placed AS (
  SELECT a.*, t.wm_in, a.ts_ms - a.ts_ms % {WINDOW_MS} + {WINDOW_MS} AS window_end_ms
  FROM arrivals a JOIN trace t ON a.batch = t.batch
), tagged AS (
  SELECT *, CASE WHEN wm_in IS NULL OR window_end_ms - 1 > wm_in THEN 'on_time'
                 WHEN window_end_ms - 1 + {LATENESS_MS} > wm_in THEN 'refired'
                 ELSE 'dropped' END AS status
  FROM placed
)"""


def bucket_sql(ts: str, seconds: int) -> str:
    """Start of the epoch-aligned bucket of ``ts``."""
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {seconds * 1_000_000})"


def window_sql(start: str, seconds: int) -> str:
    return f"{start} AS window_start, {start} + INTERVAL {seconds} SECOND AS window_end"
