"""Small fixtures with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from weirflow.functions.scalars import by_id, is_even, is_odd, parse_int, value_or
from weirflow.functions.times import bound_text, event_time, to_ntz, to_utc_timestamp
from weirflow.operators import combine, eventtime, joins, partition, project, rolling, route, state, topn, windows
from weirflow.operators.running import running_sum
from weirflow.plans import aggregating
from weirflow.sinks.files import records_per_file, with_hour_bucket
from weirflow.sources.generate import numbers
from weirflow.sources.lines import text_table
from weirflow.sources.records import LEFT_EVENT, RIGHT_EVENT, parse_records

SENSORS = [("s1", 1, 1), ("s2", 2, 2), ("s3", 1, 1)]


def sensors(spark, rows=SENSORS):
    numbered = [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, "id string, ts bigint, vc int, seq bigint")


def bag(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_word_count_over_a_text_file(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("hello river\nhello spark\nhello world\nhello java\n")
    counted = project.word_count(text_table(spark, str(path)))
    assert bag(counted, "word", "n") == [("hello", 4), ("java", 1), ("river", 1), ("spark", 1), ("world", 1)]


@pytest.mark.parametrize(
    "line,expected", [("a b", ["a", "b"]), ("a b  ", ["a", "b"]), ("", [""]), ("   ", []), (" a  b", ["", "a", "", "b"])]
)
def test_words_of_a_line(spark, line, expected):
    df = project.tokenise(spark.createDataFrame([(line,)], "value string"))
    assert [r["word"] for r in df.collect()] == expected


def test_map_filter_flat_map(spark):
    df = sensors(spark)
    assert bag(project.map_columns(df, id=F.col("id"))) == [("s1",), ("s2",), ("s3",)]
    assert bag(project.keep(df, by_id("s1")), "id", "ts", "vc") == [("s1", 1, 1)]
    values = project.branches((by_id("s1"), [F.col("vc")]), (by_id("s2"), [F.col("vc"), F.col("ts")]))
    assert bag(project.flat_map(df, values, "value", ["id"])) == [("s1", "1"), ("s2", "2"), ("s2", "2")]


def test_map_with_a_resource_per_task(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "v bigint").repartition(2)
    out = project.map_with_lifecycle(
        df,
        open_task=lambda number: [number],
        apply=lambda resource, rows: rows.assign(v=rows["v"] + 1, task=resource[0]),
        close_task=lambda resource: resource.clear(),
        schema="v bigint, task bigint",
    ).collect()
    assert sorted(r["v"] for r in out) == [2, 3, 4, 5]
    assert {r["task"] for r in out} <= {0, 1}


def test_generated_numbers_are_split_over_tasks(spark):
    df = numbers(spark, 10, 2)
    assert [r["value"] for r in df.collect()] == [f"Number: {i}" for i in range(10)]
    assert df.select(F.spark_partition_id()).distinct().count() == 2


def test_parse_policies(spark):
    lines = spark.createDataFrame([("s1,1,5",), ("s2,x,5",), ("s3,1",)], "value string")
    assert bag(parse_records(lines.limit(1))) == [("s1", 1, 5)]
    assert bag(parse_records(lines, policy="drop")) == [("s1", 1, 5)]
    kept = parse_records(lines, policy="quarantine").orderBy("id").collect()
    assert [(r["id"], r["ts"], r["vc"], r["bad_line"]) for r in kept] == [
        ("s1", 1, 5, None),
        ("s2", None, 5, "s2,x,5"),
        ("s3", 1, None, "s3,1"),
    ]
    with pytest.raises(Exception, match="bad line: s2,x,5"):
        parse_records(lines.where("value like 's2%'")).collect()
    assert bag(parse_records(spark.createDataFrame([("a,3",)], "value string"), LEFT_EVENT)) == [("a", 3)]
    assert bag(parse_records(spark.createDataFrame([("a,3,4",)], "value string"), RIGHT_EVENT)) == [("a", 3, 4)]


def test_rolling_sum_keeps_the_first_record(spark):
    df = sensors(spark, [*SENSORS, ("s1", 2, 10)])
    out = rolling.rolling_sum(df, ["id"], ["ts", "seq"], "vc", first_of=["ts"])
    assert bag(out, "id", "first_ts", "sum_vc") == [("s1", 1, 1), ("s1", 1, 11), ("s2", 2, 2), ("s3", 1, 1)]


def test_rolling_reduce_keeps_the_latest_record(spark):
    df = sensors(spark, [*SENSORS, ("s1", 2, 10)])
    out = rolling.rolling_reduce(df, ["id"], ["ts", "seq"], [running_sum("total", F.col("vc"))])
    assert bag(out, "id", "ts", "total") == [("s1", 1, 1), ("s1", 2, 11), ("s2", 2, 2), ("s3", 1, 1)]


def test_split_and_side_outputs(spark):
    texts = spark.createDataFrame([(str(i),) for i in range(1, 9)], "value string")
    value = parse_int(F.col("value"))
    parts = route.split(texts, even=is_even(value), odd=is_odd(value))
    assert bag(parts["even"]) == [("2",), ("4",), ("6",), ("8",)]
    assert bag(parts["odd"]) == [("1",), ("3",), ("5",), ("7",)]
    routed = route.route(sensors(spark), {"s1": by_id("s1"), "s2": by_id("s2")})
    assert bag(route.output(routed), "id") == [("s3",)]
    assert bag(route.output(routed, "s1"), "id") == [("s1",)]
    assert bag(route.output(routed, "s2"), "id") == [("s2",)]


def test_negative_odd_numbers_match_neither_side(spark):
    df = spark.createDataFrame([(-3,), (-2,), (3,)], "v int")
    parts = route.split(df, even=is_even(F.col("v")), odd=is_odd(F.col("v")))
    assert bag(parts["even"]) == [(-2,)] and bag(parts["odd"]) == [(3,)]


def test_alerts_leave_the_main_output_whole(spark):
    df = sensors(spark, [("s1", 1, 10), ("s1", 2, 11)])
    main, warnings = route.with_alerts(df, *route.above("vc", 10))
    assert main.count() == 2
    assert bag(warnings, "message") == [("Current Vc=11 ,is greater than 10",)]


def test_union_and_connect(spark):
    a = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5)], "v int")
    b = spark.createDataFrame([(v,) for v in (1, 1, 2, 2, 3, 3)], "v int")
    texts = spark.createDataFrame([(v,) for v in ("111", "222", "333")], "t string")
    assert combine.union_all(a, b, texts.select(parse_int(F.col("t")).alias("v"))).count() == 14
    both = combine.connect_map(a, texts, {"value": F.col("v").cast("string")}, {"value": F.col("t")})
    assert sorted(r["value"] for r in both.collect()) == ["1", "111", "2", "222", "3", "333", "4", "5"]
    with pytest.raises(ValueError):
        combine.connect_map(a, texts, {"x": F.col("v")}, {"y": F.col("t")})


def test_connect_join_gives_each_pair_once(spark):
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, name string")
    right = spark.createDataFrame(
        [(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "id int, other string, n int"
    )
    assert bag(joins.connect_join(left, right, ["id"]), "name", "other") == [
        ("a1", "aa1"), ("a1", "aa2"), ("a2", "aa1"), ("a2", "aa2"), ("b", "bb"), ("c", "cc"),
    ]


LEFT = [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
RIGHT = [("a", 1, 1), ("a", 11, 1), ("b", 2, 1), ("c", 14, 1), ("d", 15, 1)]
PAIRS = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def join_pair(spark):
    left = spark.createDataFrame(LEFT, "key string, sec int").withColumn("lts", event_time(F.col("sec")))
    right = spark.createDataFrame(RIGHT, "key string, rsec int, n int").withColumn("rts", event_time(F.col("rsec")))
    return left, right


def test_window_join(spark):
    left, right = join_pair(spark)
    out = joins.window_join(left, right, ["key"], "lts", "rts", "5 seconds")
    assert bag(out, "key", "sec", "rsec") == PAIRS


def test_interval_join_is_inclusive_and_meets_each_pair_once(spark):
    left, right = join_pair(spark)
    assert bag(joins.interval_join(left, right, ["key"], "lts", "rts", 2, 2), "key", "sec", "rsec") == PAIRS
    ten = joins.interval_join(left, right, ["key"], "lts", "rts", 0, 10)
    expected = sorted((k, s, r) for k, s in LEFT for j, r, _ in RIGHT if j == k and s <= r <= s + 10)
    assert bag(ten, "key", "sec", "rsec") == expected
    exact = joins.interval_join(left, right, ["key"], "lts", "rts", 0, 0)
    assert bag(exact, "key", "sec", "rsec") == [("a", 1, 1)]


def test_custom_partition_places_rows(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 9)], "value string")
    placed = partition.route_by_rule(df, 2, parse_int(F.col("value"))).select(F.spark_partition_id(), "value")
    assert {(p, int(v) % 2) for p, v in placed.collect()} == {(0, 0), (1, 1)}


def test_key_lives_in_one_partition(spark):
    df = spark.range(1000).select((F.col("id") % 17).alias("k"))
    placed = partition.route_by_key(df, 4, "k").select("k", F.spark_partition_id().alias("p")).distinct()
    assert placed.count() == 17


@pytest.mark.parametrize("how", [partition.rebalance, partition.shuffle_rows])
def test_redistribution_is_even_and_complete(spark, how):
    df = spark.range(0, 4000, 1, 1)
    out = how(df, 4).select("id", F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) < 400
    assert out.select(F.countDistinct("id")).first()[0] == 4000


def test_rescale_merges_neighbours(spark):
    assert partition.rescale(spark.range(0, 100, 1, 8), 2).select(F.spark_partition_id()).distinct().count() == 2


def test_replicate(spark):
    assert bag(partition.replicate(spark.range(2), 2)) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_window_reduce_and_aggregate(spark):
    rows = [*SENSORS, ("s1", 1, 3)]
    df = sensors(spark, rows).withColumn("ts", event_time(F.col("ts")))
    out = windows.window_reduce(df, ["id"], "ts", "10 seconds", ["ts", "seq"], "vc")
    got = [(r["id"], int(r["first_ts"].timestamp()), r["sum_vc"]) for r in out.orderBy("id").collect()]
    assert got == [("s1", 1, 4), ("s2", 2, 2), ("s3", 1, 1)]


def test_window_elements_go_on_over_pages(spark):
    rows = [("k", i, i) for i in range(25)]
    df = sensors(spark, rows).withColumn("ts", event_time(F.col("ts")))
    out = windows.window_elements(df, ["id"], "ts", "20 seconds", ["ts", "seq"], F.col("vc"), page_rows=8, slice_rows=5)
    got = {(int(r["window_start"].timestamp()), r["page"]): (r["n"], r["elements"]) for r in out.collect()}
    assert got == {
        (0, 0): (20, list(range(8))),
        (0, 1): (20, list(range(8, 16))),
        (0, 2): (20, list(range(16, 20))),
        (20, 0): (5, list(range(20, 25))),
    }


def test_process_windows_sees_each_window_once_in_order(spark):
    rows = [(f"k{i % 3}" if i % 5 else None, i, i) for i in range(200)]
    df = sensors(spark, rows).withColumn("ts", event_time(F.col("ts")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")

    def listed(pieces):
        pieces = list(pieces)
        head = pieces[0][["id", "window_start"]].iloc[:1]
        values = [int(v) for piece in pieces for v in piece["vc"]]
        yield head.assign(values=",".join(map(str, values)), pieces=len(pieces))

    schema = "id string, window_start timestamp, values string, pieces bigint"
    try:
        out = windows.process_windows(df, ["id"], "ts", "50 seconds", listed, schema, order=["ts", "seq"])
        got = {(r["id"], int(r["window_start"].timestamp())): r["values"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for key, at, vc in rows:
        expected.setdefault((key, at - at % 50), []).append(str(vc))
    assert got == {k: ",".join(v) for k, v in expected.items()}


def test_rows_of_windows_from_arrow_batches(spark, tmp_path):
    from datetime import datetime, timedelta

    big = (1 << 53) + 1  # no double
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=5 * i), None if i % 3 == 0 else big + i % 2, "view", None if i % 7 == 0 else float(i)) for i in range(60)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {(r["id"], r["window_start"]): (r["spread"], r["n"]) for r in aggregating.window_process(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    windows_of = {}
    for _, ts, user, _, value in rows:
        windows_of.setdefault((user, datetime(ts.year, ts.month, ts.day)), []).append(value)
    expected = {}
    for key, values in windows_of.items():
        known = [int(v) for v in values if v is not None]
        expected[key] = (max(known) - min(known) if known else None, len(values))
    assert got == expected


def test_runs_of_rows_are_told_apart():
    import pyarrow as pa

    nan = float("nan")
    columns = [pa.array([None, None, nan, nan, 0.0, 0.0, 1.0, None]), pa.array([1, 1, 1, 1, 1, 2, 2, 2])]
    assert windows._run_starts(columns) == [0, 2, 4, 5, 6, 7]
    batches = [pa.RecordBatch.from_arrays([c.slice(k, 1) for c in columns], ["a", "b"]) for k in range(8)]
    schema = pa.schema([("a", pa.float64()), ("b", pa.int64()), ("n", pa.int64())])
    out = windows._rows_one_by_one(iter(batches), ["a", "b"], lambda pieces: iter([(sum(p.num_rows for p in pieces),)]), ["a", "b"], schema)
    assert [n for batch in out for n in batch.column(2).to_pylist()] == [2, 2, 1, 1, 1, 1]


def test_sessions_that_touch_merge(spark):
    rows = [("k", 0, 1), ("k", 5, 1), ("k", 11, 1)]
    df = sensors(spark, rows).withColumn("ts", event_time(F.col("ts")))
    out = windows.session_windows(df, ["id"], ["ts", "seq"], 5, n=F.count(F.lit(1)))
    native = df.groupBy("id", F.session_window("ts", "5 seconds")).count()
    assert sorted(r["n"] for r in out.collect()) == sorted(r["count"] for r in native.collect()) == [1, 2]


def test_user_aggregate_over_many_batches(spark):
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = rolling.user_aggregate(
        df,
        ["k"],
        add=lambda groups: groups["v"].agg(lo="min", hi="max"),
        merge=lambda groups: groups.agg({"lo": "min", "hi": "max"}),
        result=lambda accs: (accs["hi"] - accs["lo"]).astype(str).to_frame("spread"),
        accumulator="lo bigint, hi bigint",
        output="spread string",
        flush_rows=3,
    )
    expected = df.groupBy("k").agg((F.max("v") - F.min("v")).cast("string").alias("spread"))
    assert bag(out) == bag(expected)


def test_top_values_agree_and_break_ties_by_value(spark):
    rows = [("a", t, v) for t, v in [(0, 3), (1, 3), (2, 1), (3, 2), (4, 9), (11, 5)]]
    df = sensors(spark, rows).withColumn("ts", event_time(F.col("ts")))
    one = topn.top_values(df, "ts", "vc", 2, "10 seconds", "5 seconds")
    two = topn.top_values_two_stage(df, "ts", "vc", 2, "10 seconds", "5 seconds", salts=3)
    columns = ["window_start", "vc", "n", "rank"]
    assert bag(one, *columns) == bag(two, *columns)
    first = one.where(F.col("window_start") == F.timestamp_seconds(F.lit(0)))
    assert bag(first, "rank", "vc", "n") == [(1, 3, 2), (2, 1, 1)]


def test_state_twins(spark):
    df = sensors(spark, [("k", 1, 5), ("k", 2, 20), ("k", 9, 21), ("j", 1, 11)])
    keys, order = ["id"], ["ts", "seq"]
    assert bag(state.jumps(df, keys, order, "vc", 10), "id", "vc", "prev_vc") == [("j", 11, 0), ("k", 20, 5)]
    timed = df.withColumn("ts", event_time(F.col("ts")))
    alive = state.last_within(timed, keys, order, "vc", 7)
    assert bag(alive, "id", "vc", "last_vc") == [("j", 11, 0), ("k", 5, 0), ("k", 20, 5), ("k", 21, 0)]
    counted = state.record_counter(df, keys, order)
    assert bag(counted, "id", "counter") == [("j", 0), ("k", 0), ("k", 1), ("k", 2)]


def test_watermark_boundaries(spark):
    """A window closes exactly when max_ts - delay reaches its end."""
    rows = [("k", 0, 9_999), ("k", 1, 13_000), ("k", 2, 9_000), ("k", 3, 30_000)]
    df = spark.createDataFrame(rows, "id string, batch bigint, ts_ms bigint").withColumn("vc", F.lit(1))
    trace = eventtime.watermark_trace(df, "batch", "ts_ms", 3_000)
    marks = {r["batch"]: (r["wm_in"], r["wm_out"]) for r in trace.collect()}
    assert marks == {0: (None, 6_998), 1: (6_998, 9_999), 2: (9_999, 9_999), 3: (9_999, 26_999)}
    late = eventtime.late_split(df, trace, "batch", "ts_ms", 10_000)
    assert {r["batch"]: r["status"] for r in late.collect()} == {0: "on_time", 1: "on_time", 2: "dropped", 3: "on_time"}
    revised = eventtime.allowed_lateness(df, ["id"], trace, "batch", "ts_ms", 10_000, 2_000, "vc")
    assert bag(revised, "window_end_ms", "firing_batch", "revision", "n") == [
        (10_000, 1, 0, 1), (10_000, 2, 1, 2), (20_000, 3, 0, 1), (40_000, 4, 0, 1),
    ]
    timers = df.withColumn("at_ms", F.col("ts_ms") + 1)
    fired = eventtime.event_timers(timers, ["id"], "at_ms", trace, "batch")
    assert bag(fired.fillna(-1), "at_ms", "fire_batch") == [(9_001, 1), (10_000, 3), (13_001, 3), (30_001, -1)]


def test_idle_source_does_not_hold_the_watermark(spark):
    rows = [("a", 0, 1_000), ("b", 0, 500), ("a", 1, 2_000), ("a", 2, 3_000), ("a", 3, 4_000), ("b", 4, 900)]
    df = spark.createDataFrame(rows, "src string, batch bigint, ts_ms bigint")
    out = eventtime.source_watermarks(df, "src", "batch", "ts_ms", 0, 2)
    assert bag(out, "batch", "active_sources", "wm") == [
        (0, 2, 499), (1, 2, 499), (2, 1, 2_999), (3, 1, 3_999), (4, 2, 3_999), (5, 1, 3_999),
    ]


def test_times(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 12:34:56.789012' AS t")
    assert df.select(to_ntz(to_utc_timestamp(F.col("t"))) == F.col("t")).first()[0]
    assert df.select(bound_text(F.col("t"))).first()[0] == "2024-07-01 12:34:56.789"
    assert df.transform(lambda d: with_hour_bucket(d, F.col("t"))).first()["bucket"] == "2024-07-01 12"
    assert spark.sql("SELECT CAST(NULL AS INT) AS v").select(value_or(F.col("v"), 0)).first()[0] == 0
    assert records_per_file(31) == 32
