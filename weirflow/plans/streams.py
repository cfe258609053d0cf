"""Streaming forms over whole tables; each must give the rows of its batch counterpart.

However many files a table has: windows and joins replay it in the order of arrival, with a watermark that trails
by no more than records are late, and what follows the order of records replays the table in event-time order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.times import bound_text, to_ntz, to_utc_timestamp, widened
from weirflow.operators import project, route
from weirflow.operators.running import running_sum
from weirflow.plans import aggregating, joining, stateless, timing  # noqa: F401  (shared SQL)
from weirflow.plans.registry import SQL, query
from weirflow.plans.views import DELAY_MS, LATENESS_MS, SENSOR_SQL, SPREAD_FACTOR, SPREAD_SECONDS, WINDOW_MS, arrivals, bucket_sql, of_kind, table, window_sql
from weirflow.session import use_joint_state_store, use_keyed_state_store
from weirflow.sinks.files import start_text_sink, write_rolled
from weirflow.sinks.routed import routed_output, start_routed_sink
from weirflow.sources.lines import line_stream, table_stream, text_table
from weirflow.sources.records import DROP, RIGHT_EVENT, parse_records
from weirflow.sources.replay import ordered_stream, paced_stream
from weirflow.streaming import carried, elements, joins, late, runs, sessions, stateful, windows

KEY, ORDER = ["id"], ["ts", "seq"]


def _readings(events):
    """The sensor view with an instant as event time."""
    return events.select(
        F.col("user_id").alias("id"),
        to_utc_timestamp(F.col("ts")).alias("ts"),
        F.floor("value").cast("int").alias("vc"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
    )


def sensor_stream(spark, sf_dir):
    """The readings as a stream, in the order of the table's files."""
    return _readings(table_stream(spark, f"{sf_dir}/events.parquet"))


def sensor_replay(spark, sf_dir, slice_rows=1_000_000):
    """The readings as a stream in event-time order, for keyed state that follows the order of records."""
    readings = _readings(table(spark, sf_dir, "events"))
    return ordered_stream(readings, "ts", f"{runs.run_folder(spark)}/replay", slice_rows)


def sensor_arrivals(spark, sf_dir, slice_rows=1_000_000):
    """The readings as a stream in the order in which they came in, up to ``DISORDER`` after their event time."""
    readings = _readings(table(spark, sf_dir, "events"))
    came = F.unix_seconds("ts") + F.pmod(F.col("seq") * SPREAD_FACTOR, F.lit(SPREAD_SECONDS))
    stream = ordered_stream(readings.withColumn("came", came), "came", f"{runs.run_folder(spark)}/arrivals", slice_rows)
    return stream.drop("came")


# The watermark delay that leaves no row late.
DISORDER = f"{SPREAD_SECONDS} seconds"


def _zoneless(df, *names):
    return df.withColumns({name: to_ntz(F.col(name)) for name in names})


def result(stream, *ntz, mode="append"):
    out = runs.run_available(stream, mode)
    return _zoneless(runs.last_batch(out) if mode == "complete" else out.drop("batch_id"), *ntz)


def carried_result(keyed):
    return carried.run_available(keyed).drop("batch_id")


def windowed(spark, sf_dir, build, *ntz):
    """Result of event-time windows over the whole sensor stream, the last ones included.

    Windows close, and leave the state, ``DISORDER`` after their end.
    """

    def watermarked(stream):
        return build(windows.out_of_order(stream, "ts", DISORDER))

    return _zoneless(runs.run_to_end(sensor_arrivals(spark, sf_dir), "ts", watermarked).drop("batch_id"), *ntz)


BOUNDS = ("window_start", "window_end")


def _n():
    return F.count(F.lit(1))


@query("stream_word_count", SQL["text_scan_wordcount"])
def stream_word_count(spark, sf_dir):
    lines = project.split_lines(table_stream(spark, f"{sf_dir}/documents.parquet"), "text")
    return runs.last_per_key(runs.run_available(project.word_count(lines), "update"), ["word"])


@query("stream_tumbling_count", SQL["tumbling_count"])
def stream_tumbling_count(spark, sf_dir):
    return windowed(spark, sf_dir, lambda s: windows.event_windows(s, KEY, "ts", "1 hour", n=_n()), *BOUNDS)


@query("stream_sliding_count", SQL["sliding_count"])
def stream_sliding_count(spark, sf_dir):
    def counted(stream):
        return windows.event_windows(stream, KEY, "ts", "2 hours", "1 hour", n=_n(), sum_vc=F.sum("vc"))

    return windowed(spark, sf_dir, counted, *BOUNDS)


def _session_sql(name: str) -> str:
    return f"SELECT id, session_start AS window_start, session_end AS window_end, n, sum_vc FROM ({SQL[name]})"


@query("stream_session_fixed", _session_sql("session_fixed"))
def stream_session_fixed(spark, sf_dir):
    def hourly(stream):
        return windows.event_sessions(stream, KEY, "ts", "1 hour", n=_n(), sum_vc=F.sum("vc"))

    return windowed(spark, sf_dir, hourly, *BOUNDS)


def _count_and_sum(df):
    return [running_sum("n", F.lit(1).cast("bigint")), running_sum("sum_vc", widened(df, "vc"))]


def _ended(keyed, folder):
    """All sessions of a stream that has ended, those that are still open included."""
    out = carried.run_available(keyed, folder)
    batches = out.agg(F.max("batch_id")).first()[0]
    states = carried.states_after(keyed, folder, 0 if batches is None else batches + 1)
    return out.drop("batch_id").unionByName(sessions.open_sessions(states))


@query("stream_session_dynamic", _session_sql("session_dynamic"))
def stream_session_dynamic(spark, sf_dir):
    """Sessions with a gap of each record's own, an empty one included."""
    keyed = sessions.event_sessions(sensor_arrivals(spark, sf_dir), KEY, "ts", F.col("vc") * 60, _count_and_sum, SPREAD_SECONDS)
    out = _ended(keyed, runs.run_folder(spark))
    bounds = [to_ntz(F.timestamp_micros(c)).alias(n) for c, n in zip(("start_us", "end_us"), BOUNDS)]
    return out.select("id", *bounds, "n", "sum_vc")


@query("stream_window_full", SQL["window_full"])
def stream_window_full(spark, sf_dir):
    """All elements of each window in pages, as it closes; those that are open at the end come last."""
    day, page, folder = aggregating.DAY, aggregating.PAGE, runs.run_folder(spark)
    stream = sensor_arrivals(spark, sf_dir)
    keyed = elements.window_elements(stream, KEY, "ts", day, ORDER, F.col("vc").cast("string"), SPREAD_SECONDS, page)
    out = carried.run_available(keyed, folder)
    batches = out.agg(F.max("batch_id")).first()[0]
    states = carried.states_after(keyed, folder, 0 if batches is None else batches + 1)
    every = out.drop("batch_id").unionByName(elements.open_windows(keyed, states, KEY, "ts", day, ORDER, page))
    return _zoneless(every, *BOUNDS).withColumn("elements", F.concat_ws(",", "elements"))


SILENT_SECONDS = 6 * 3600


@query(
    "stream_inactive_keys",
    f"""WITH {SENSOR_SQL}, following AS (SELECT id, ts, lead(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS later FROM sensor)
    SELECT id, ts AS last_ts, ts + INTERVAL {SILENT_SECONDS} SECOND AS at_ts FROM following
    WHERE later IS NULL OR later > ts + INTERVAL {SILENT_SECONDS} SECOND""",
)
def stream_inactive_keys(spark, sf_dir):
    """An alert for each time that a key has been silent for six hours; a record before that puts it off."""
    keyed = sessions.event_sessions(sensor_arrivals(spark, sf_dir), KEY, "ts", SILENT_SECONDS, _count_and_sum, SPREAD_SECONDS)
    out = _ended(keyed, runs.run_folder(spark))
    return out.select("id", *[to_ntz(F.timestamp_micros(c)).alias(n) for c, n in (("last_us", "last_ts"), ("end_us", "at_ts"))])


@query("stream_broadcast_threshold", SQL["broadcast_threshold"])
def stream_broadcast_threshold(spark, sf_dir):
    """Each signup sets the threshold that all later readings are compared with, by event time."""
    threshold = sessions.in_force(
        sensor_arrivals(spark, sf_dir), F.lit(True), F.col("kind") == "signup", "ts", "seq", F.col("vc"), "threshold", SPREAD_SECONDS
    )
    out = carried_result(threshold).withColumn("threshold", F.coalesce("threshold", F.lit(0)))
    return out.where("vc > threshold").select("id", "seq", "vc", "threshold")


@query("stream_top_of_windows", f"SELECT epoch_ms(window_end) AS window_end_ms, vc, n, rank FROM ({SQL['topn_two_stage']})")
def stream_top_of_windows(spark, sf_dir):
    use_keyed_state_store(spark)

    def top(stream):
        counts = windows.event_windows(stream, ["vc"], "ts", "2 hours", "1 hour", n=_n())
        return stateful.top_of_windows(counts.withColumn("window_end_ms", F.unix_millis("window_end")), 2)

    return windowed(spark, sf_dir, top)


def _sides(spark, sf_dir):
    """Both sides of a join, of one replay, so that a micro-batch has the same hours of both."""
    use_joint_state_store(spark)
    arrived = sensor_arrivals(spark, sf_dir)
    left = of_kind(arrived, "click").select("id", F.col("ts").alias("left_ts"), F.col("seq").alias("left_seq"))
    right = of_kind(arrived, "purchase").select(
        "id", F.col("ts").alias("right_ts"), F.col("seq").alias("right_seq")
    )
    return windows.out_of_order(left, "left_ts", DISORDER), windows.out_of_order(right, "right_ts", DISORDER)


@query("stream_interval_join", SQL["interval_join"])
def stream_interval_join(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    pairs = joins.interval_join(left, right, KEY, "left_ts", "right_ts", joining.BOUND_SECONDS, joining.BOUND_SECONDS)
    return result(pairs, "left_ts", "right_ts")


@query("stream_window_join", SQL["window_join"])
def stream_window_join(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    pairs = joins.window_join(left, right, KEY, "left_ts", "right_ts", "1 hour")
    pairs = pairs.select(
        "id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "left_seq", "right_seq"
    )
    return result(pairs, "window_start", "window_end")


@query("stream_connect_join", SQL["connect_join"])
def stream_connect_join(spark, sf_dir):
    orders = table_stream(spark, f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey")
    )
    lines = table_stream(spark, f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
    )
    return result(joins.connect_join(orders, lines, ["orderkey"]))


@query("stream_value_diff", SQL["state_value_diff"])
def stream_value_diff(spark, sf_dir):
    return carried_result(carried.jumps(sensor_replay(spark, sf_dir), KEY, ORDER, "vc", timing.JUMP))


@query("stream_top3", SQL["state_top3"])
def stream_top3(spark, sf_dir):
    out = carried_result(carried.top_so_far(sensor_replay(spark, sf_dir), KEY, ORDER, "vc", 3))
    return out.withColumn("top", F.concat_ws(",", F.transform("top", lambda v: v.cast("string"))))


@query("stream_map_counts", SQL["state_map_counts"])
def stream_map_counts(spark, sf_dir):
    """The entry of the key's value-to-count map that each record changes."""
    return carried_result(carried.value_counts_so_far(sensor_replay(spark, sf_dir), KEY, ORDER, "vc"))


@query("stream_running_sum", SQL["state_running_sum"])
def stream_running_sum(spark, sf_dir):
    return carried_result(carried.running_sums(sensor_replay(spark, sf_dir), KEY, ORDER, "vc"))


@query("stream_running_avg", SQL["state_running_avg"])
def stream_running_avg(spark, sf_dir):
    return carried_result(carried.running_averages(sensor_replay(spark, sf_dir), KEY, ORDER, "vc"))


@query("stream_record_counter", SQL["running_counter"])
def stream_record_counter(spark, sf_dir):
    return carried_result(carried.record_counters(sensor_replay(spark, sf_dir), KEY, ORDER))


@query("stream_reduce_by", SQL["rolling_reduce_by"])
def stream_reduce_by(spark, sf_dir):
    """Running reduce with any function, over micro-batches."""
    lettered = sensor_replay(spark, sf_dir).withColumn("kinds", F.substring("kind", 1, 1))
    out = carried_result(carried.reduced_by(lettered, KEY, ORDER, ["kinds"], aggregating.joined_tail))
    return out.select("id", "seq", "reduced_kinds")


@query("stream_global_window", SQL["global_window_trigger"])
def stream_global_window(spark, sf_dir):
    return carried_result(carried.global_window(sensor_replay(spark, sf_dir), KEY, ORDER, "vc", lambda n: n % 3 == 0))


@query("stream_count_window_tumbling", f"SELECT id, window_no, n, elements FROM ({SQL['count_window_tumbling']})")
def stream_count_window_tumbling(spark, sf_dir):
    out = carried_result(carried.count_windows(sensor_replay(spark, sf_dir), KEY, ORDER, "vc", 5))
    return out.withColumn("elements", F.concat_ws(",", F.transform("elements", lambda v: v.cast("string"))))


@query("stream_count_window_sliding", f"SELECT id, window_no, n, elements FROM ({SQL['count_window_sliding']})")
def stream_count_window_sliding(spark, sf_dir):
    out = carried_result(carried.count_windows(sensor_replay(spark, sf_dir), KEY, ORDER, "vc", 5, 2))
    return out.withColumn("elements", F.concat_ws(",", F.transform("elements", lambda v: v.cast("string"))))


@query("stream_routed_outputs", SQL["route_by_tag"])
def stream_routed_outputs(spark, sf_dir):
    """Each tag's rows in its own directory, from one pass."""
    folder = runs.run_folder(spark)
    tags = {"clicks": F.col("kind") == "click", "views": F.col("kind") == "view"}
    routed = route.route(sensor_stream(spark, sf_dir), tags).select("seq", "vc", "tag")
    start_routed_sink(routed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return routed_output(spark, routed, f"{folder}/out")


ALERT = 400


@query(
    "stream_alert_outputs",
    f"""WITH sensor AS (SELECT event_id AS seq, CAST(floor(value) AS INTEGER) AS vc FROM events)
    SELECT seq, 'main' AS tag, NULL AS message FROM sensor
    UNION ALL SELECT seq, 'alert', 'Current Vc=' || vc || ' ,is greater than {ALERT}' FROM sensor WHERE vc > {ALERT}""",
)
def stream_alert_outputs(spark, sf_dir):
    """All readings in the main output, and an alert beside it for each one above the limit."""
    folder = runs.run_folder(spark)
    condition, message = route.above("vc", ALERT)
    tagged = route.beside_main(sensor_stream(spark, sf_dir), {"alert": condition})
    outputs = tagged.select("seq", F.when(F.col("tag") == "alert", message).alias("message"), "tag")
    start_routed_sink(outputs, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return routed_output(spark, outputs, f"{folder}/out")


@query("stream_text_sink", "SELECT event_id || ',' || event_type AS value FROM events")
def stream_text_sink(spark, sf_dir):
    """Lines written by the bucketed, rolling text sink and read back by the text source."""
    folder = runs.run_folder(spark)
    lines = sensor_stream(spark, sf_dir).select(F.concat_ws(",", F.col("seq").cast("string"), "kind").alias("value"))
    start_text_sink(lines, f"{folder}/out", f"{folder}/checkpoint", None, max_records=2000).awaitTermination()
    return text_table(spark, f"{folder}/out").select("value")


def arrival_replay(spark, sf_dir, slice_rows=1_000_000):
    """The disordered arrivals as a stream, in the order of their arrival batches."""
    rows = arrivals(spark, sf_dir).drop("ts", "kind")
    return ordered_stream(rows, "batch", f"{runs.run_folder(spark)}/arrivals", slice_rows)


@query("stream_late_split", SQL["late_split"])
def stream_late_split(spark, sf_dir):
    """Rows on time, within the allowed lateness, and beyond it, by a watermark ten minutes behind."""
    out = carried_result(late.late_split(arrival_replay(spark, sf_dir), "ts_ms", DELAY_MS, WINDOW_MS, LATENESS_MS, "batch"))
    return out.select("id", "seq", "batch", "window_end_ms", "wm_in", "status")


@query("stream_allowed_lateness", SQL["allowed_lateness"])
def stream_allowed_lateness(spark, sf_dir):
    """Window results and their revisions; what is open when the table ends fires last."""
    stream = arrival_replay(spark, sf_dir)
    keyed = late.allowed_lateness(
        stream, KEY, "ts_ms", DELAY_MS, WINDOW_MS, LATENESS_MS, lambda df: [running_sum("sum_vc", widened(df, "vc"))], "batch"
    )
    folder = runs.run_folder(spark)
    out = carried.run_available(keyed, folder)
    batches = out.agg(F.max("batch_id")).first()[0]
    states = carried.states_after(keyed, folder, 0 if batches is None else batches + 1)
    return out.drop("batch_id").unionByName(late.close_windows(states))


@query(
    "stream_interval_join_with_late",
    f"""SELECT 'pair' AS output, id, left_seq, right_seq, CAST(NULL AS BIGINT) AS ts_ms, CAST(NULL AS BIGINT) AS wm_in FROM ({SQL['interval_join_on_time']})
    UNION ALL SELECT 'left', id, left_seq, NULL, ts_ms, wm_in FROM ({SQL['interval_join_late_left']})
    UNION ALL SELECT 'right', id, NULL, right_seq, ts_ms, wm_in FROM ({SQL['interval_join_late_right']})""",
)
def stream_interval_join_with_late(spark, sf_dir):
    """The interval join and the late rows of both its sides, from one pass."""
    rows = arrivals(spark, sf_dir)
    left, right = joining._sides(rows, "batch", "ts_ms")
    both = ordered_stream(
        late.tagged(left, right, KEY, "ts_ms", "batch"), "batch", f"{runs.run_folder(spark)}/arrivals"
    )
    joined = late.interval_join_with_late(
        both, KEY, "left_ts", "right_ts", joining.BOUND_SECONDS, joining.BOUND_SECONDS, "ts_ms", DELAY_MS, "batch"
    )
    out = carried_result(joined)
    return out.select("output", "id", F.col("left.left_seq").alias("left_seq"), F.col("right.right_seq").alias("right_seq"), "ts_ms", "wm_in")


# Readings that come in per second of the clock of processing time.
PACE = 20
_PACED_SQL = f"""WITH {SENSOR_SQL}, paced AS (
  SELECT *, make_timestamp(((row_number() OVER (ORDER BY ts, seq) - 1) // {PACE}) * 1000000) AS pt FROM sensor
)"""


def _processing(spark, sf_dir, size, slide=None):
    paced = paced_stream(_readings(table(spark, sf_dir, "events")), ORDER, f"{runs.run_folder(spark)}/paced", PACE)

    def counted(stream):
        return windows.processing_windows(stream, KEY, size, slide, F.col("pt"), n=_n(), sum_vc=F.sum("vc"))

    return _zoneless(runs.run_to_end(paced, "pt", counted).drop("batch_id"), *BOUNDS)


@query(
    "stream_processing_tumbling",
    f"""{_PACED_SQL} SELECT id, {window_sql(bucket_sql("pt", 10), 10)}, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc FROM paced GROUP BY ALL""",
)
def stream_processing_tumbling(spark, sf_dir):
    """Windows of ten seconds by the time of processing, by the clock of a replay at a fixed rate."""
    return _processing(spark, sf_dir, "10 seconds")


@query(
    "stream_processing_sliding",
    f"""{_PACED_SQL}, slid AS (
      SELECT id, vc, {bucket_sql("pt", 2)} - INTERVAL 2 SECOND * k AS ws FROM paced, (SELECT unnest(range(5)) AS k)
    ) SELECT id, {window_sql("ws", 10)}, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc FROM slid GROUP BY ALL""",
)
def stream_processing_sliding(spark, sf_dir):
    """Windows of ten seconds, one every two."""
    return _processing(spark, sf_dir, "10 seconds", "2 seconds")


@query("stream_parse_lines", SQL["parse_sensor_lines"])
def stream_parse_lines(spark, sf_dir):
    """Comma-separated lines in text files, read as a stream of lines and parsed to records; bad lines are left out."""
    folder = f"{runs.run_folder(spark)}/lines"
    stateless._reading_lines(spark, sf_dir).write.text(folder)
    lines = line_stream(spark, "text", folder, maxBytesPerTrigger=1 << 30, pathGlobFilter="part-*")
    return result(parse_records(lines, policy=DROP))


@query(
    "stream_parse_tuples",
    f"WITH {SENSOR_SQL} SELECT kind AS key, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS sec, vc AS n FROM sensor",
)
def stream_parse_tuples(spark, sf_dir):
    """Lines parsed to tuples of key, second and number; a bad one would end the stream."""
    folder = f"{runs.run_folder(spark)}/lines"
    readings = _readings(table(spark, sf_dir, "events"))
    fields = ["kind", F.unix_seconds("ts").cast("string"), F.col("vc").cast("string")]
    readings.select(F.concat_ws(",", *fields).alias("value")).write.text(folder)
    return result(parse_records(line_stream(spark, "text", folder, maxBytesPerTrigger=1 << 30), RIGHT_EVENT))


ROLL = 16384


@query(
    "text_sink_rolled",
    f"""WITH lines AS (SELECT event_id AS seq, event_id || ',' || event_type AS value FROM events), placed AS (
      SELECT *, coalesce(sum(strlen(value) + 1) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {ROLL} AS file_no
      FROM lines
    ) SELECT min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n, CAST(sum(strlen(value) + 1) AS BIGINT) AS n_bytes
    FROM placed GROUP BY file_no""",
)
def text_sink_rolled(spark, sf_dir):
    """Lines in files that roll at a number of bytes: what each written file holds."""
    folder = f"{runs.run_folder(spark)}/rolled"
    readings = _readings(table(spark, sf_dir, "events"))
    lines = readings.select("seq", F.concat_ws(",", F.col("seq").cast("string"), "kind").alias("value"))
    write_rolled(lines, folder, ["seq"], ROLL)
    seq = F.split_part("value", F.lit(","), F.lit(1)).cast("bigint")
    read = spark.read.text(folder).withColumn("_file", F.col("_metadata.file_path"))
    held = [F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), _n().alias("n")]
    return read.groupBy("_file").agg(*held, F.sum(F.octet_length("value") + 1).alias("n_bytes")).drop("_file")


@query(
    "stream_count_window_bounds",
    f"""WITH {SENSOR_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS rn FROM sensor)
    SELECT id, (rn - 1) // 5 + 1 AS window_no, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%g') AS first_text,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g') AS last_text
    FROM numbered GROUP BY 1, 2 HAVING count(*) = 5""",
)
def stream_count_window_bounds(spark, sf_dir):
    """Count windows with the times of their first and last records, as text."""
    timed = sensor_replay(spark, sf_dir).withColumn("at", to_ntz(F.col("ts")))
    out = carried_result(carried.count_windows(timed, KEY, ORDER, "at", 5))
    bounds = {"first_text": bound_text(F.array_min("elements")), "last_text": bound_text(F.array_max("elements"))}
    return out.withColumns(bounds).drop("elements")
