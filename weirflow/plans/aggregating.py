"""Rolling, grouped and windowed aggregation, and Top-N."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from weirflow.functions.times import bound_text
from weirflow.operators import reducing, rolling, topn, windows
from weirflow.operators.running import running_sum
from weirflow.plans.registry import query
from weirflow.plans.views import SENSOR_SQL, bucket_sql, sensor, window_sql

HOUR, TWO_HOURS, DAY = 3600, 7200, 86400
KEY, ORDER = ["id"], ["ts", "seq"]
RUN = "PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING"


def _n():
    return F.count(F.lit(1))


def _joined(value: str):
    """The values of a bounded group in arrival order, as text."""
    listed = F.array_sort(F.collect_list(F.struct("ts", "seq", value)))
    return F.concat_ws(",", F.transform(listed, lambda x: x[value].cast("string")))


@query(
    "rolling_sum",
    f"""WITH {SENSOR_SQL} SELECT id, seq, first_value(ts) OVER ({RUN}) AS first_ts,
    CAST(sum(vc) OVER ({RUN}) AS BIGINT) AS sum_vc FROM sensor""",
)
def rolling_sum(spark, sf_dir):
    out = rolling.rolling_sum(sensor(spark, sf_dir).drop("kind"), KEY, ORDER, "vc", first_of=["ts"])
    return out.select("id", "seq", "first_ts", "sum_vc")


@query("rolling_reduce", f"WITH {SENSOR_SQL} SELECT id, ts, seq, CAST(sum(vc) OVER ({RUN}) AS BIGINT) AS vc FROM sensor")
def rolling_reduce(spark, sf_dir):
    """The latest record of the key with the sum of all its values."""
    readings = sensor(spark, sf_dir).select("id", "ts", "seq", "vc")
    out = rolling.rolling_reduce(readings, KEY, ORDER, [running_sum("total", F.col("vc").cast("bigint"))])
    return out.select("id", "ts", "seq", F.col("total").alias("vc"))


def _extreme_sql(fn: str) -> str:
    return f"""WITH {SENSOR_SQL} SELECT id, seq, first_value(ts) OVER ({RUN}) AS first_ts,
    {fn}(vc) OVER ({RUN}) AS best_vc FROM sensor"""


def _extreme_by_sql(fn: str, sign: str) -> str:
    # The earliest record among those that hold the extreme: rank value and position in one integer.
    return f"""WITH {SENSOR_SQL}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS rn FROM sensor
    ), ranked AS (
      SELECT *, {fn}(CAST(vc AS BIGINT) * 1000000000 {sign} rn)
             OVER (PARTITION BY id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS best FROM numbered
    )
    SELECT r.id, r.seq, b.ts AS best_ts, b.vc AS best_vc, b.seq AS best_seq
    FROM ranked r JOIN numbered b ON r.id = b.id AND r.best = CAST(b.vc AS BIGINT) * 1000000000 {sign} b.rn"""


def _extreme(spark, sf_dir, largest):
    readings = sensor(spark, sf_dir).drop("kind")
    out = rolling.rolling_extreme(readings, KEY, ORDER, "vc", first_of=["ts"], largest=largest)
    return out.select("id", "seq", "first_ts", "best_vc")


def _extreme_by(spark, sf_dir, largest):
    readings = sensor(spark, sf_dir).drop("kind")
    out = rolling.rolling_extreme_by(readings, KEY, ORDER, "vc", record=["ts", "vc", "seq"], largest=largest)
    return out.select("id", "seq", "best_ts", "best_vc", "best_seq")


@query("rolling_max", _extreme_sql("max"))
def rolling_max(spark, sf_dir):
    return _extreme(spark, sf_dir, True)


@query("rolling_min", _extreme_sql("min"))
def rolling_min(spark, sf_dir):
    return _extreme(spark, sf_dir, False)


@query("rolling_max_by", _extreme_by_sql("max", "-"))
def rolling_max_by(spark, sf_dir):
    return _extreme_by(spark, sf_dir, True)


@query("rolling_min_by", _extreme_by_sql("min", "+"))
def rolling_min_by(spark, sf_dir):
    return _extreme_by(spark, sf_dir, False)


@query(
    "udaf_sum",
    f"WITH {SENSOR_SQL} SELECT id, CAST(sum(vc) AS VARCHAR) AS total, count(*) AS n FROM sensor GROUP BY id",
)
def udaf_sum(spark, sf_dir):
    """A user-defined aggregate: integers in, (sum, count) accumulated, text out."""
    return rolling.user_aggregate(
        sensor(spark, sf_dir).select("id", "vc"),
        KEY,
        add=lambda groups: groups["vc"].agg(acc="sum", n="size"),
        merge=lambda groups: groups[["acc", "n"]].sum(),
        result=lambda accs: accs[["acc"]].astype(str).rename(columns={"acc": "total"}).assign(n=accs["n"]),
        accumulator="acc bigint, n bigint",
        output="total string, n bigint",
    )


@query("group_count", f"WITH {SENSOR_SQL} SELECT vc, count(*) AS n FROM sensor GROUP BY vc")
def group_count(spark, sf_dir):
    return rolling.grouped(sensor(spark, sf_dir), ["vc"], n=_n())


@query("group_avg", f"WITH {SENSOR_SQL} SELECT id, CAST(sum(vc) AS DOUBLE) / count(*) AS avg_vc FROM sensor GROUP BY id")
def group_avg(spark, sf_dir):
    return rolling.grouped(sensor(spark, sf_dir), KEY, avg_vc=F.sum("vc") / _n())


_TUMBLE = bucket_sql("ts", HOUR)


@query(
    "tumbling_count",
    f"WITH {SENSOR_SQL} SELECT id, {window_sql(_TUMBLE, HOUR)}, count(*) AS n FROM sensor GROUP BY ALL",
)
def tumbling_count(spark, sf_dir):
    return windows.time_windows(sensor(spark, sf_dir), KEY, "ts", "1 hour", n=_n())


_SLIDING_SQL = f"""{SENSOR_SQL}, slid AS (
  SELECT *, {_TUMBLE} - to_seconds({HOUR} * range) AS ws FROM sensor, range({TWO_HOURS // HOUR})
)"""


@query(
    "sliding_count",
    f"""WITH {_SLIDING_SQL} SELECT id, {window_sql("ws", TWO_HOURS)}, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM slid GROUP BY ALL""",
)
def sliding_count(spark, sf_dir):
    return windows.time_windows(sensor(spark, sf_dir), KEY, "ts", "2 hours", "1 hour", n=_n(), sum_vc=F.sum("vc"))


@query(
    "window_all",
    f"""WITH {SENSOR_SQL} SELECT {window_sql(_TUMBLE, HOUR)}, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc,
    max(vc) AS max_vc FROM sensor GROUP BY ALL""",
)
def window_all(spark, sf_dir):
    """One window over all keys; only partial aggregates are shuffled."""
    return windows.time_windows(sensor(spark, sf_dir), [], "ts", "1 hour", n=_n(), sum_vc=F.sum("vc"), max_vc=F.max("vc"))


def _session_sql(gap: str) -> str:
    return f"""WITH {SENSOR_SQL}, covered AS (SELECT *, ts + to_seconds({gap}) AS until FROM sensor),
    reached AS (
      SELECT *, max(until) OVER (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM covered
    ), numbered AS (
      SELECT *, sum(CASE WHEN reach IS NULL OR ts > reach THEN 1 ELSE 0 END)
             OVER (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS no FROM reached
    )
    SELECT id, CAST(no AS BIGINT) AS session_no, min(ts) AS session_start, max(until) AS session_end, count(*) AS n,
           CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM numbered GROUP BY id, no"""


@query("session_fixed", _session_sql(str(HOUR)))
def session_fixed(spark, sf_dir):
    return windows.session_windows(sensor(spark, sf_dir), KEY, ORDER, HOUR, n=_n(), sum_vc=F.sum("vc"))


@query("session_dynamic", _session_sql("vc * 60"))
def session_dynamic(spark, sf_dir):
    """Each record keeps its session open for as many minutes as its value."""
    return windows.session_windows(sensor(spark, sf_dir), KEY, ORDER, F.col("vc") * 60, n=_n(), sum_vc=F.sum("vc"))


_NUMBERED = f"{SENSOR_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS rn FROM sensor)"


@query(
    "count_window_tumbling",
    f"""WITH {_NUMBERED} SELECT id, (rn - 1) // 5 + 1 AS window_no, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc,
    string_agg(CAST(vc AS VARCHAR), ',' ORDER BY rn) AS elements FROM numbered GROUP BY 1, 2 HAVING count(*) = 5""",
)
def count_window_tumbling(spark, sf_dir):
    readings = sensor(spark, sf_dir).drop("kind")
    return windows.count_windows(readings, KEY, ORDER, 5, sum_vc=F.sum("vc"), elements=_joined("vc"))


@query(
    "count_window_sliding",
    f"""WITH {_NUMBERED}, held AS (
      SELECT *, list(vc) OVER (PARTITION BY id ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS held FROM numbered
    ) SELECT id, rn // 2 AS window_no, len(held) AS n, CAST(list_sum(held) AS BIGINT) AS sum_vc,
             array_to_string(held, ',') AS elements
    FROM held WHERE rn % 2 = 0""",
)
def count_window_sliding(spark, sf_dir):
    readings = sensor(spark, sf_dir).drop("kind")
    return windows.count_windows(readings, KEY, ORDER, 5, 2, sum_vc=F.sum("vc"), elements=_joined("vc"))


@query(
    "global_window_trigger",
    f"""WITH {_NUMBERED}, folded AS (SELECT *, CAST(sum(vc) OVER ({RUN}) AS BIGINT) AS sum_vc FROM numbered)
    SELECT id, seq, rn AS n, sum_vc FROM folded WHERE rn % 3 = 0""",
)
def global_window_trigger(spark, sf_dir):
    """Fires at every third record of a key with everything so far."""
    readings = sensor(spark, sf_dir).drop("kind")
    folds = [running_sum("sum_vc", F.col("vc").cast("bigint"))]
    fired = windows.global_window(readings, KEY, ORDER, lambda count: count % 3 == 0, folds)
    return fired.select("id", "seq", "n", "sum_vc")


@query(
    "window_reduce",
    f"""WITH {SENSOR_SQL} SELECT id, {window_sql(bucket_sql("ts", DAY), DAY)}, arg_min(ts, ts) AS first_ts,
    CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY ALL""",
)
def window_reduce(spark, sf_dir):
    return windows.window_reduce(sensor(spark, sf_dir), KEY, "ts", "1 day", ORDER, "vc")


# The last eight kinds of events of a key, each by its first letter: an order that a sum would not see.
TAIL = 8


def joined_tail(a, b):
    """Joins two pieces of text in their order and keeps the end."""
    return ((a[0] + b[0])[-TAIL:],)


def joined(a, b):
    return (a[0] + b[0],)


def lettered(readings):
    return readings.select("id", "ts", "seq", F.substring("kind", 1, 1).alias("kinds"))


@query(
    "rolling_reduce_by",
    f"""WITH {SENSOR_SQL} SELECT id, seq, string_agg(kind[1:1], '') OVER (
      PARTITION BY id ORDER BY ts, seq ROWS BETWEEN {TAIL - 1} PRECEDING AND CURRENT ROW) AS reduced_kinds FROM sensor""",
)
def rolling_reduce_by(spark, sf_dir):
    """Running reduce with a function that no aggregate has and whose order matters."""
    out = reducing.running_reduce(lettered(sensor(spark, sf_dir)), KEY, ORDER, ["kinds"], joined_tail)
    return out.select("id", "seq", "reduced_kinds")


@query(
    "window_reduce_by",
    f"""WITH {SENSOR_SQL} SELECT id, {window_sql(bucket_sql("ts", DAY), DAY)}, string_agg(kind[1:1], '' ORDER BY ts, seq) AS kinds
    FROM sensor GROUP BY ALL""",
)
def window_reduce_by(spark, sf_dir):
    """Tumbling windows reduced with such a function."""
    return reducing.window_reduce(lettered(sensor(spark, sf_dir)), KEY, "ts", "1 day", ORDER, ["kinds"], joined)


@query(
    "window_aggregate",
    f"WITH {SENSOR_SQL} SELECT id, {window_sql(bucket_sql('ts', DAY), DAY)}, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY ALL",
)
def window_aggregate(spark, sf_dir):
    return windows.time_windows(sensor(spark, sf_dir), KEY, "ts", "1 day", sum_vc=F.sum("vc"))


PAGE = 1000


@query(
    "window_full",
    f"""WITH {SENSOR_SQL}, placed AS (SELECT *, {window_sql(bucket_sql('ts', DAY), DAY)} FROM sensor), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY id, window_start ORDER BY ts, seq) AS rn,
             count(*) OVER (PARTITION BY id, window_start) AS n FROM placed
    ) SELECT id, window_start, window_end, CAST((rn - 1) // {PAGE} AS INTEGER) AS page, n,
             string_agg(CAST(vc AS VARCHAR), ',' ORDER BY rn) AS elements
    FROM numbered GROUP BY ALL""",
)
def window_full(spark, sf_dir):
    """All elements of each window with its key, bounds and count."""
    readings = sensor(spark, sf_dir)
    out = windows.window_elements(readings, KEY, "ts", "1 day", ORDER, F.col("vc").cast("string"), PAGE)
    return out.withColumn("elements", F.concat_ws(",", "elements"))


_RANGE_SQL = f"""WITH {SENSOR_SQL} SELECT id, {window_sql(bucket_sql('ts', DAY), DAY)}, max(vc) - min(vc) AS spread,
    count(*) AS n FROM sensor GROUP BY ALL"""


def _spread(pieces: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Spread and count of one window, read piece by piece."""
    low, high, count = None, None, 0
    for rows in pieces:
        least, most = pc.min_max(rows.column("vc")).values()
        if least.is_valid:
            least, most = least.as_py(), most.as_py()
            low, high = (least, most) if low is None else (min(low, least), max(high, most))
        count += rows.num_rows
    yield None if low is None else high - low, count


@query("window_process", _RANGE_SQL)
def window_process(spark, sf_dir):
    """Opaque Python logic per key and window."""
    schema = "id bigint, window_start timestamp_ntz, window_end timestamp_ntz, spread int, n bigint"
    readings = sensor(spark, sf_dir).select("id", "ts", "vc")
    return windows.process_windows(readings, KEY, "ts", "1 day", _spread, schema, as_rows=True)


@query(
    "window_agg_with_bounds",
    f"""WITH {SENSOR_SQL}, w AS (SELECT *, {bucket_sql('ts', DAY)} AS ws FROM sensor)
    SELECT id, strftime(ws, '%Y-%m-%d %H:%M:%S.%g') AS start_text,
           strftime(ws + INTERVAL {DAY} SECOND, '%Y-%m-%d %H:%M:%S.%g') AS end_text,
           count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM w GROUP BY id, ws""",
)
def window_agg_with_bounds(spark, sf_dir):
    """Incremental aggregate wrapped with the window's bounds as text."""
    out = windows.time_windows(sensor(spark, sf_dir), KEY, "ts", "1 day", n=_n(), sum_vc=F.sum("vc"))
    return out.select(
        "id", bound_text(F.col("window_start")).alias("start_text"), bound_text(F.col("window_end")).alias("end_text"),
        "n", "sum_vc",
    )


_TOP_SQL = f"""WITH {_SLIDING_SQL}, counts AS (
  SELECT {window_sql("ws", TWO_HOURS)}, vc, count(*) AS n FROM slid GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, vc) AS INTEGER) AS rank FROM counts
) SELECT window_start, window_end, vc, n, rank FROM ranked WHERE rank <= 2"""


@query("topn_window_all", _TOP_SQL)
def topn_window_all(spark, sf_dir):
    return topn.top_values(sensor(spark, sf_dir), "ts", "vc", 2, "2 hours", "1 hour")


@query("topn_two_stage", _TOP_SQL)
def topn_two_stage(spark, sf_dir):
    return topn.top_values_two_stage(sensor(spark, sf_dir), "ts", "vc", 2, "2 hours", "1 hour")
