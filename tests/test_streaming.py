"""Streams replayed in several micro-batches, against their batch counterparts."""

import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.replay import add_batch, replay, replay_lines
from weirflow.operators import combine, eventtime, partition, project, rolling, route, state, topn
from weirflow.operators import joins as batch_joins
from weirflow.operators import windows as batch_windows
from weirflow.sinks.files import start_text_sink
from weirflow.sinks.routed import routed_output, start_routed_sink
from weirflow.sources.generate import number_batches, number_stream
from weirflow.sources.lines import line_stream
from weirflow.sources.records import LEFT_EVENT, RIGHT_EVENT, parse_records
from weirflow.streaming import control, joins, runs, stateful, windows

SCHEMA = "id string, ts timestamp, vc int, seq bigint"
KEY, ORDER = ["id"], ["ts", "seq"]


def at(second: float) -> datetime:
    return datetime.fromtimestamp(second, timezone.utc).replace(tzinfo=None)


def ordered_batches(batches: int = 3, rows: int = 60) -> list[list[tuple]]:
    rng, out, seq = random.Random(3), [], 0
    for number in range(batches):
        batch = []
        for _ in range(rows // batches):
            batch.append((rng.choice("abc"), at(seq * 2 + 1), rng.randrange(40), seq))
            seq += 1
        out.append(batch)
    return out


def disordered_batches() -> list[list[tuple]]:
    rng, rows = random.Random(5), []
    for seq in range(150):
        rows.append((rng.randrange(6), (rng.choice("ab"), at(1_000 + seq), rng.randrange(40), seq)))
    # Arrival: the batch of the event's own time plus a delay of up to two batches.
    out = [[] for _ in range(9)]
    for _, row in rows:
        out[min(8, row[3] // 20 + rng.choice([0, 0, 0, 1, 2]))].append(row)
    return out


def table(spark, batches):
    numbered = [(*row, number) for number, rows in enumerate(batches) for row in rows]
    return spark.createDataFrame(numbered, SCHEMA + ", batch bigint")


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def to_end(stream, build):
    return runs.run_to_end(stream, "ts", lambda s: build(windows.monotonous(s, "ts")))


def test_lines_parsed_and_counted_in_update_mode(spark, tmp_path):
    lines = replay_lines(spark, tmp_path / "in", [["a b", "a"], ["a c"]])
    counts = project.word_count(lines)
    out = runs.run_available(counts, "update")
    assert bag(out, "batch_id", "word", "n") == [(0, "a", 2), (0, "b", 1), (1, "a", 3), (1, "c", 1)]


def test_bad_line_fails_or_is_kept_aside(spark, tmp_path):
    batches = [["s1,1,5"], ["s2,x,5"]]
    with pytest.raises(Exception, match="bad line"):
        runs.run_available(parse_records(replay_lines(spark, tmp_path / "a", batches)))
    out = runs.run_available(parse_records(replay_lines(spark, tmp_path / "b", batches), policy="quarantine"))
    assert bag(out, "id", "bad_line") == [("s1", None), ("s2", "s2,x,5")]


def test_file_glob_limits_the_stream(spark, tmp_path):
    replay_lines(spark, tmp_path, [["x"]])
    (tmp_path / "other.csv").write_text("y\n")
    out = runs.run_available(line_stream(spark, "text", str(tmp_path), pathGlobFilter="*.txt"))
    assert bag(out, "value") == [("x",)]


@pytest.mark.parametrize("slide", [None, "5 seconds"])
def test_event_windows_emit_once_and_all(spark, tmp_path, slide):
    batches = ordered_batches()
    stream = replay(spark, tmp_path / "in", SCHEMA, batches)
    out = to_end(stream, lambda s: windows.event_windows(s, KEY, "ts", "10 seconds", slide, total=F.sum("vc")))
    twin = batch_windows.time_windows(table(spark, batches), KEY, "ts", "10 seconds", slide, total=F.sum("vc"))
    columns = ["id", "window_start", "window_end", "total"]
    assert bag(out, *columns) == bag(twin, *columns)
    assert out.select("batch_id").distinct().count() > 1


def test_out_of_order_watermark_waits(spark, tmp_path):
    batches = [[("k", at(1), 1, 0)], [("k", at(12), 1, 1)], [("k", at(2), 1, 2)], [("k", at(13), 1, 3)], [("k", at(30), 1, 4)]]
    stream = windows.out_of_order(replay(spark, tmp_path / "in", SCHEMA, batches), "ts", "3 seconds")
    out = runs.run_available(windows.event_windows(stream, KEY, "ts", "10 seconds", n=F.count("*")))
    first = out.where(F.col("window_start") == F.timestamp_seconds(F.lit(0)))
    assert bag(first, "n") == [(2,)]


@pytest.mark.parametrize("dynamic", [False, True])
def test_sessions(spark, tmp_path, dynamic):
    batches = ordered_batches()
    gap_seconds = (F.col("vc") % 7) + 1 if dynamic else F.lit(4)
    gap = windows.gap_seconds(F.coalesce(gap_seconds, F.lit(1))) if dynamic else "4 seconds"
    stream = replay(spark, tmp_path / "in", SCHEMA, batches)
    out = to_end(stream, lambda s: windows.event_sessions(s, KEY, "ts", gap, n=F.count("*")))
    twin = batch_windows.session_windows(table(spark, batches), KEY, ORDER, gap_seconds, n=F.count("*"))
    twin = twin.withColumnsRenamed({"session_start": "window_start", "session_end": "window_end"})
    columns = ["id", "window_start", "window_end", "n"]
    assert bag(out, *columns) == bag(twin, *columns)


def test_processing_time_windows(spark, tmp_path):
    batches = ordered_batches()
    for slide in (None, "1 second"):
        stream = replay(spark, tmp_path / f"in-{slide}", SCHEMA, batches)
        windowed = windows.processing_windows(stream, KEY, "2 seconds", slide, n=F.count("*"))
        out = runs.last_batch(runs.run_available(windowed, "complete"))
        times = 2 if slide else 1
        assert out.agg(F.sum("n")).first()[0] == 60 * times
    stream = replay(spark, tmp_path / "in-session", SCHEMA, batches)
    out = runs.last_batch(runs.run_available(windows.processing_sessions(stream, KEY, "1 hour", n=F.count("*")), "complete"))
    assert out.agg(F.sum("n")).first()[0] == 60


JOIN_LEFT = "key string, lts timestamp, lseq bigint"
JOIN_RIGHT = "key string, rts timestamp, rseq bigint"


def join_batches():
    rng = random.Random(8)
    left = [[(rng.choice("ab"), at(100 * b + rng.randrange(100)), b * 20 + i) for i in range(12)] for b in range(3)]
    right = [[(rng.choice("ab"), at(100 * b + rng.randrange(100)), b * 20 + i) for i in range(12)] for b in range(3)]
    return left, right


@pytest.mark.parametrize("kind", ["equi", "interval", "window"])
def test_stream_joins(spark, tmp_path, kind):
    left_rows, right_rows = join_batches()
    left = replay(spark, tmp_path / "l", JOIN_LEFT, left_rows)
    right = replay(spark, tmp_path / "r", JOIN_RIGHT, right_rows)
    a = spark.createDataFrame(sum(left_rows, []), JOIN_LEFT)
    b = spark.createDataFrame(sum(right_rows, []), JOIN_RIGHT)
    if kind == "equi":
        out, twin = joins.connect_join(left, right, ["key"]), batch_joins.connect_join(a, b, ["key"])
    else:
        left, right = left.withWatermark("lts", "100 seconds"), right.withWatermark("rts", "100 seconds")
        if kind == "interval":
            out = joins.interval_join(left, right, ["key"], "lts", "rts", 5, 9)
            twin = batch_joins.interval_join(a, b, ["key"], "lts", "rts", 5, 9)
        else:
            out = joins.window_join(left, right, ["key"], "lts", "rts", "20 seconds")
            twin = batch_joins.window_join(a, b, ["key"], "lts", "rts", "20 seconds")
    got = bag(runs.run_available(out), "key", "lseq", "rseq")
    assert got == bag(twin, "key", "lseq", "rseq") and got


def test_join_inputs_parsed_from_lines(spark, tmp_path):
    left = parse_records(replay_lines(spark, tmp_path / "l", [["a,1", "a,2"], ["b,3", "c,4"]]), LEFT_EVENT)
    right = parse_records(replay_lines(spark, tmp_path / "r", [["a,1,1", "a,11,1"], ["b,2,1", "c,14,1", "d,15,1"]]), RIGHT_EVENT)
    left = left.select("key", F.timestamp_seconds("sec").alias("lts"), "sec").withWatermark("lts", "3 seconds")
    right = right.select("key", F.timestamp_seconds("sec").alias("rts"), F.col("sec").alias("rsec"), "n")
    pairs = joins.interval_join(left, right.withWatermark("rts", "3 seconds"), ["key"], "lts", "rts", 2, 2)
    assert bag(runs.run_available(pairs), "key", "sec", "rsec") == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_late_rows_of_a_join_go_to_outputs_of_their_own(spark, tmp_path):
    rng = random.Random(21)

    def side(offset):
        batches = [[] for _ in range(6)]
        for seq in range(60):
            batches[min(5, seq // 10 + rng.choice([0, 0, 1, 2]))].append((rng.choice("ab"), at(500 + seq), offset + seq))
        return batches

    left_rows, right_rows = side(0), side(1000)
    tagged = joins.tagged_inputs(
        replay(spark, tmp_path / "l", JOIN_LEFT, left_rows),
        replay(spark, tmp_path / "r", JOIN_RIGHT, right_rows),
        ["key"], "lts", "rts", "3 seconds", "3 seconds",
    )
    routed = route.route(
        tagged,
        {"late_left": F.expr("late AND side = 'left'"), "late_right": F.expr("late AND side = 'right'")},
    )
    folder = str(tmp_path / "out")
    start_routed_sink(routed, folder, str(tmp_path / "cp")).awaitTermination()

    def twin(batches, schema, ts):
        rows = [(*row, number) for number, batch in enumerate(batches) for row in batch]
        return spark.createDataFrame(rows, schema + ", batch bigint").withColumn("ts_ms", F.unix_millis(ts))

    pairs, late_left, late_right = eventtime.interval_join_with_late(
        twin(left_rows, JOIN_LEFT, "lts"), twin(right_rows, JOIN_RIGHT, "rts"),
        ["key"], "lts", "rts", 2, 2, "batch", "ts_ms", 3_000,
    )
    late = routed_output(spark, routed, folder, "late_left")
    assert bag(late, "left.lseq") == bag(late_left, "lseq") and late.count() > 0
    assert bag(routed_output(spark, routed, folder, "late_right"), "right.rseq") == bag(late_right, "rseq")
    on_time = spark.readStream.schema(routed.schema).parquet(folder).where("tag = 'main'").drop("tag")
    a, b = (on_time.where(F.col("side") == name).select(f"{name}.*") for name in ("left", "right"))
    joined = runs.run_available(joins.interval_join(a, b, ["key"], "lts", "rts", 2, 2))
    assert bag(joined, "lseq", "rseq") == bag(pairs, "lseq", "rseq") and pairs.count() > 0


def test_union_of_streams(spark, tmp_path):
    a = replay_lines(spark, tmp_path / "a", [["1", "2"], ["3"]]).select(F.col("value").cast("int").alias("v"))
    b = replay_lines(spark, tmp_path / "b", [["1"], ["2"]]).select(F.col("value").cast("int").alias("v"))
    assert bag(runs.run_available(combine.union_all(a, b)), "v") == [(1,), (1,), (2,), (2,), (3,)]


def test_empty_partitions_do_not_hold_windows_back(spark, tmp_path):
    """One partition gets all rows, the other none; windows still close."""
    batches = [[("k", at(t), t, t)] for t in (1, 3, 11, 25)]
    stream = replay(spark, tmp_path / "in", SCHEMA, batches)
    routed = partition.route_by_rule(stream, 2, F.col("seq"))
    out = runs.run_available(windows.event_windows(windows.monotonous(routed, "ts"), KEY, "ts", "10 seconds", n=F.count("*")))
    assert bag(out, "n") == [(1,), (2,)]


def _pairs():
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_rn", "vc"))), lambda x: x["vc"])
    return {
        "jumps": (
            lambda s: stateful.jumps(s, KEY, ORDER, "vc", 10),
            lambda t: state.jumps(t, KEY, ORDER, "vc", 10),
            ["seq", "vc", "prev_vc"],
        ),
        "top": (
            lambda s: stateful.top_so_far(s, KEY, ORDER, "vc", 3),
            lambda t: state.top_so_far(t, KEY, ORDER, "vc", 3),
            ["seq", "top"],
        ),
        "sum": (
            lambda s: stateful.running_sum(s, KEY, ORDER, "vc"),
            lambda t: rolling.rolling_sum(t, KEY, ORDER, "vc"),
            ["seq", "sum_vc"],
        ),
        "average": (
            lambda s: stateful.running_average(s, KEY, ORDER, "vc"),
            lambda t: rolling.rolling_average(t, KEY, ORDER, "vc"),
            ["seq", "avg_vc"],
        ),
        "counter": (
            lambda s: stateful.record_counter(s, KEY, ORDER),
            lambda t: state.record_counter(t, KEY, ORDER),
            ["seq", "counter"],
        ),
        "count windows": (
            lambda s: stateful.count_windows(s, KEY, ORDER, "vc", 5),
            lambda t: batch_windows.count_windows(t, KEY, ORDER, 5, elements=listed),
            ["id", "window_no", "n", "elements"],
        ),
        "sliding count windows": (
            lambda s: stateful.count_windows(s, KEY, ORDER, "vc", 5, 2),
            lambda t: batch_windows.count_windows(t, KEY, ORDER, 5, 2, elements=listed),
            ["id", "window_no", "n", "elements"],
        ),
    }


@pytest.mark.parametrize(
    "name", ["jumps", "top", "sum", "average", "counter", "count windows", "sliding count windows"]
)
def test_keyed_state_goes_on_over_batches(spark, tmp_path, name):
    batches = ordered_batches()
    streaming, twin, columns = _pairs()[name]
    out = runs.run_available(streaming(replay(spark, tmp_path / "in", SCHEMA, batches)))
    assert bag(out, *columns) == bag(twin(table(spark, batches)), *columns)


def test_map_state_emits_the_changed_entry(spark, tmp_path):
    batches = [[("k", at(1), 5, 0), ("k", at(2), 6, 1)], [("k", at(3), 5, 2), ("j", at(4), 5, 3)]]
    out = runs.run_available(stateful.value_counts_so_far(replay(spark, tmp_path / "in", SCHEMA, batches), KEY, ORDER, "vc"))
    assert bag(out, "id", "seq", "vc", "n") == [("j", 3, 5, 1), ("k", 0, 5, 1), ("k", 1, 6, 1), ("k", 2, 5, 2)]


def test_general_reduce(spark, tmp_path):
    batches = ordered_batches()

    def step(held, row):
        total = row["vc"] if held is None else held[1] + row["vc"]
        return (row["ts"], total), [(row["seq"], row["ts"], total)]

    stream = replay(spark, tmp_path / "in", SCHEMA, batches)
    out = runs.run_available(
        stateful.reduced(stream, KEY, ORDER, "ts timestamp, total bigint", "seq bigint, ts timestamp, total bigint", step)
    )
    twin = rolling.rolling_sum(table(spark, batches), KEY, ORDER, "vc")
    assert bag(out, "seq", "ts", "total") == bag(twin, "seq", "ts", "sum_vc")


def test_counter_survives_a_restart(spark, tmp_path):
    batches = ordered_batches()
    source, folder = tmp_path / "in", str(tmp_path / "run")
    runs.run_available(stateful.record_counter(replay(spark, source, SCHEMA, batches[:2]), KEY, ORDER), folder=folder)
    add_batch(spark, source, SCHEMA, batches[2], 2)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = runs.run_available(stateful.record_counter(stream, KEY, ORDER), folder=folder)
    twin = state.record_counter(table(spark, batches), KEY, ORDER)
    assert bag(out, "seq", "counter") == bag(twin, "seq", "counter")


def test_state_expires_and_writes_refresh_it(spark, tmp_path):
    source = tmp_path / "in"
    stream = replay(spark, source, SCHEMA, [[("k", at(1), 7, 0)]])
    last = stateful.last_with_ttl(stream, KEY, ORDER, "vc", 4_000)
    folder = str(tmp_path / "run")
    started = runs._start(last, "append", folder, processingTime="200 milliseconds")
    try:
        seen = []

        def wait_for(count):
            deadline = time.time() + 40
            while time.time() < deadline:
                try:
                    seen[:] = runs._written(last, folder).collect()
                except Exception:
                    seen.clear()
                if len(seen) >= count:
                    return
                time.sleep(0.2)
            raise AssertionError("no result in time")

        wait_for(1)
        add_batch(spark, source, SCHEMA, [("k", at(2), 8, 1)], 1)
        wait_for(2)
        time.sleep(6)
        add_batch(spark, source, SCHEMA, [("k", at(3), 9, 2)], 2)
        wait_for(3)
    finally:
        started.stop()
    got = {r["seq"]: r["last_vc"] for r in seen}
    assert got[0] == 0 and got[1] in (0, 7) and got[2] == 0


def test_processing_time_timer_fires_after_the_delay(spark, tmp_path):
    stream = replay(spark, tmp_path / "in", SCHEMA, [[("k", at(1), 7, 0), ("j", at(1), 7, 1)]])
    out = runs.run_for(stateful.delay_timers(stream, KEY, 1_000), 12)
    registered = {r["id"]: r["at_ms"] for r in out.where("event = 'registered'").collect()}
    fired = {r["id"]: r["at_ms"] for r in out.where("event = 'fired'").collect()}
    assert registered == fired and set(fired) == {"j", "k"}


def without_event_time(stream, delay, *columns):
    """Watermarked stream whose late rows are kept: the watermark column is projected away."""
    marked = stream.withWatermark("ts", delay)
    return marked.select(*columns, F.unix_millis("ts").alias("ts_ms"))


def test_event_timers_fire_when_the_watermark_gets_there(spark, tmp_path):
    batches = ordered_batches()

    def build(stream):
        rows = without_event_time(stream, "0 seconds", "id", "seq")
        timed = rows.withColumn("at_ms", F.col("ts_ms") - F.col("ts_ms") % 10_000 + 10_001)
        return stateful.event_timers(timed, KEY, "at_ms")

    out = runs.run_to_end(replay(spark, tmp_path / "in", SCHEMA, batches), "ts", build)
    expected = table(spark, batches).select("id", (F.unix_millis("ts") - F.unix_millis("ts") % 10_000 + 10_001).alias("t")).distinct()
    assert bag(out, "id", "timer_ms") == bag(expected, "id", "t")
    assert out.where("wm_ms < timer_ms").count() == 0


def test_late_rows_are_tagged_by_the_watermark_of_their_batch(spark, tmp_path):
    batches = disordered_batches()
    stream = without_event_time(replay(spark, tmp_path / "in", SCHEMA, batches), "5 seconds", "id", "seq")
    out = runs.run_available(stateful.late_tagged(stream, KEY, "ts_ms"))
    rows = table(spark, batches).withColumn("ts_ms", F.unix_millis("ts"))
    trace = eventtime.watermark_trace(rows, "batch", "ts_ms", 5_000)
    on_time, late = eventtime.split_late(rows, trace, "batch", "ts_ms")
    assert bag(out.where("late"), "seq") == bag(late, "seq")
    assert bag(out.where("not late"), "seq") == bag(on_time, "seq")
    assert late.count() > 0


def test_allowed_lateness_revises_then_drops(spark, tmp_path):
    batches = disordered_batches()

    def build(stream):
        rows = without_event_time(stream, "5 seconds", "id", "vc", "seq")
        placed = rows.withColumn("window_end_ms", F.col("ts_ms") - F.col("ts_ms") % 10_000 + 10_000)
        return stateful.allowed_lateness(placed, KEY, ["seq"], "vc", 8_000)

    out = runs.run_to_end(replay(spark, tmp_path / "in", SCHEMA, batches), "ts", build)

    rows = table(spark, batches).withColumn("ts_ms", F.unix_millis("ts"))
    trace = eventtime.watermark_trace(rows, "batch", "ts_ms", 5_000)
    twin = eventtime.allowed_lateness(rows, KEY, trace, "batch", "ts_ms", 10_000, 8_000, "vc")
    dropped = eventtime.late_split(rows, trace, "batch", "ts_ms", 10_000, 8_000).where("status = 'dropped'")
    results = out.where("event = 'result'")
    columns = ["id", "window_end_ms", "revision", "n", "sum_vc"]
    assert bag(results, *columns) == bag(twin, *columns)
    assert bag(out.where("event = 'late'"), "late_seq") == bag(dropped, "seq")
    assert results.where("revision > 0").count() > 0 and dropped.count() > 0


def test_top_of_windows(spark, tmp_path):
    batches = ordered_batches()

    def build(stream):
        counts = windows.event_windows(stream, ["vc"], "ts", "20 seconds", "10 seconds", n=F.count("*"))
        return stateful.top_of_windows(counts.withColumn("window_end_ms", F.unix_millis("window_end")), 2)

    out = to_end(replay(spark, tmp_path / "in", SCHEMA, batches), build)
    twin = topn.top_values_two_stage(table(spark, batches), "ts", "vc", 2, "20 seconds", "10 seconds")
    twin = twin.withColumn("window_end_ms", F.unix_millis("window_end"))
    columns = ["window_end_ms", "vc", "n", "rank"]
    assert bag(out, *columns) == bag(twin, *columns)


def test_threshold_changes_between_batches(spark, tmp_path):
    settings = tmp_path / "control"
    data = tmp_path / "in"
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    settings.mkdir()
    schema = "threshold int, seq bigint"

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(data))
        read = lambda: spark.read.schema(schema).parquet(str(settings))
        control.start_threshold_alerts(stream, read, "vc", path, checkpoint).awaitTermination()

    replay(spark, data, SCHEMA, [[("k", at(1), 0, 0), ("k", at(2), 3, 1)]])
    run()
    add_batch(spark, settings, schema, [(10, 1), (5, 0)], 0)
    add_batch(spark, data, SCHEMA, [("k", at(3), 9, 2), ("k", at(4), 11, 3)], 1)
    run()
    out = spark.read.parquet(path)
    assert bag(out, "seq", "threshold") == [(1, 0), (3, 10)]


def test_routed_outputs_in_one_pass(spark, tmp_path):
    batches = ordered_batches()
    stream = replay(spark, tmp_path / "in", SCHEMA, batches)
    condition, message = route.above("vc", 10)
    routed = route.route(stream.withColumn("message", message), {"warn": condition})
    folder = tmp_path / "out"
    start_routed_sink(routed, str(folder), str(tmp_path / "cp")).awaitTermination()
    warn, main = (routed_output(spark, routed, str(folder), tag) for tag in ("warn", "main"))
    rows = table(spark, batches)
    assert bag(warn, "seq") == bag(rows.where("vc > 10"), "seq")
    assert bag(main, "seq") == bag(rows.where("vc <= 10"), "seq")
    # The same batches again, as after a lost commit: nothing is doubled.
    start_routed_sink(routed, str(folder), str(tmp_path / "cp2")).awaitTermination()
    assert routed_output(spark, routed, str(folder), "warn").count() == rows.where("vc > 10").count()


def test_text_sink_buckets_and_rolls(spark, tmp_path):
    stream = number_batches(spark, rows_per_batch=50, partitions=2)
    path = tmp_path / "out"
    start_text_sink(stream, str(path), str(tmp_path / "cp"), None, max_records=10).awaitTermination()
    files = list(path.glob("bucket=*/*.txt"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert sorted(lines) == sorted(f"Number: {i}" for i in range(50))
    assert max(len(f.read_text().splitlines()) for f in files) <= 10


def test_rate_limited_generator(spark):
    out = runs.run_for(number_stream(spark, rows_per_second=10), 8, every="1 second")
    values = sorted(int(r["value"].split(": ")[1]) for r in out.collect())
    assert values == list(range(len(values))) and len(values) <= 80
