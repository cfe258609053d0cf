"""Keyed state and late data as state tables: many micro-batches, repeated ones, hot and null keys, what is left in the states."""

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tests.oracle import database
from tests.replay import replay
from weirflow.operators import eventtime, rolling, state, windows
from weirflow.operators.running import running_sum
from weirflow.plans import joining, streams
from weirflow.plans.registry import SQL
from weirflow.plans.views import DELAY_MS, LATENESS_MS, WINDOW_MS, arrivals
from weirflow.session import materialise, shared_dir
from weirflow.sources.replay import ordered_stream
from weirflow.streaming import carried, late

SF = "/root/testdata/sf0.001"
ROW = "id string, ts bigint, seq bigint, vc int"
KEY, ORDER = ["id"], ["ts", "seq"]


def bag(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


@pytest.fixture(scope="module")
def readings():
    """A hot key, a null key, null times and values, equal times; in the order of time, nulls first."""
    rng = random.Random(8)
    rows = []
    for seq in range(300):
        key = rng.choice(["hot", "hot", "hot", None, "a", "b"])
        rows.append((key, None if seq < 5 else seq // 3, seq, rng.choice([None, 1, 2, 5, 30, -4])))
    return rows


FORMS = {
    "sums": (carried.running_sums, lambda df: rolling.rolling_sum(df, KEY, ORDER, "vc"), ["seq", "sum_vc"]),
    "averages": (carried.running_averages, lambda df: rolling.rolling_average(df, KEY, ORDER, "vc"), ["seq", "avg_vc"]),
    "top": (carried.top_so_far, lambda df: state.top_so_far(df, KEY, ORDER, "vc", 3), ["id", "seq", "top"]),
    "counts": (carried.value_counts_so_far, lambda df: state.value_counts_so_far(df, KEY, ORDER, "vc"), ["id", "seq", "vc", "n"]),
}


@pytest.mark.parametrize("slice_rows", [20, None])
@pytest.mark.parametrize("name", FORMS)
def test_micro_batches_go_on_where_the_last_one_ended(spark, tmp_path, readings, name, slice_rows):
    form, batch_form, columns = FORMS[name]
    stream = replay(spark, tmp_path / "in", ROW, [readings[:60], readings[60:200], readings[200:]])
    out = carried.run_available(form(stream, KEY, ORDER, "vc", slice_rows=slice_rows), str(tmp_path / "run"), every=2)
    assert out.select("batch_id").distinct().count() == 3
    assert bag(out, *columns) == bag(batch_form(spark.createDataFrame(readings, ROW)), *columns)


@pytest.mark.parametrize("slide", [None, 2])
def test_count_windows_over_micro_batches(spark, tmp_path, readings, slide):
    stream = replay(spark, tmp_path / "in", ROW, [readings[:7], readings[7:130], readings[130:131], readings[131:]])
    keyed = carried.count_windows(stream, KEY, ORDER, "vc", 5, slide, slice_rows=25)
    out = carried.run_available(keyed, str(tmp_path / "run"), every=2)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "vc"))), lambda x: x["vc"])
    twin = windows.count_windows(spark.createDataFrame(readings, ROW), KEY, ORDER, 5, slide, elements=listed)
    assert bag(out, "id", "window_no", "n", "elements") == bag(twin, "id", "window_no", "n", "elements")
    left = carried.states_after(keyed, str(tmp_path / "run"), 4, every=2)["recent"]
    assert left.count() == 4 and left.agg(F.max(F.size("recent"))).first()[0] < 5


def test_jumps_counters_and_global_windows(spark, tmp_path, readings):
    whole = [row[:3] + (row[3] or 0,) for row in readings]
    parts = [whole[:130], whole[130:]]
    df = spark.createDataFrame(whole, ROW)

    def run(form, name):
        return carried.run_available(form(replay(spark, tmp_path / name, ROW, parts)), str(tmp_path / f"{name}-run"))

    found = run(lambda s: carried.jumps(s, KEY, ORDER, "vc", 3), "jumps")
    assert bag(found, "seq", "vc", "prev_vc") == bag(state.jumps(df, KEY, ORDER, "vc", 3), "seq", "vc", "prev_vc")
    found = run(lambda s: carried.record_counters(s, KEY, ORDER), "counters")
    assert bag(found, "seq", "counter") == bag(state.record_counter(df, KEY, ORDER), "seq", "counter")
    found = run(lambda s: carried.global_window(s, KEY, ORDER, "vc", lambda n: n % 4 == 0), "global")
    twin = windows.global_window(df, KEY, ORDER, lambda n: n % 4 == 0, [running_sum("sum_vc", F.col("vc").cast("bigint"))])
    assert bag(found, "seq", "n", "sum_vc") == bag(twin, "seq", "n", "sum_vc")


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, readings):
    keyed = carried.running_sums(replay(spark, tmp_path / "in", ROW, [readings]), KEY, ORDER, "vc")
    batches = [spark.createDataFrame(readings[at : at + 100], ROW) for at in range(0, 300, 100)]
    for number in (0, 0, 1, 2, 2, 1, 2):
        carried.process(keyed, batches[number], number, str(tmp_path / "run"), every=2)
    twin = rolling.rolling_sum(spark.createDataFrame(readings, ROW), KEY, ORDER, "vc")
    assert bag(carried.written(keyed, str(tmp_path / "run")), "seq", "sum_vc") == bag(twin, "seq", "sum_vc")


def test_one_key_with_very_many_rows(spark, tmp_path):
    rows = spark.range(1_000_000).select(F.lit("k").alias("id"), F.col("id").alias("ts"), F.col("id").alias("seq"), F.lit(1).alias("vc"))
    stream = ordered_stream(rows, "ts", str(tmp_path / "in"), 600_000)
    out = carried.run_available(carried.running_sums(stream, KEY, ORDER, "vc", slice_rows=100_000), str(tmp_path / "run"))
    assert out.where(F.col("sum_vc") == F.col("seq") + 1).count() == 1_000_000
    assert out.select("batch_id").distinct().count() == 2


@pytest.mark.parametrize("form", [carried.value_counts_so_far, carried.top_so_far, carried.count_windows, "reduced_by"])
def test_states_do_not_pass_through_the_driver(spark, readings, form):
    batch = spark.createDataFrame(readings, ROW)
    if form == "reduced_by":
        keyed = carried.reduced_by(batch, KEY, ORDER, ["vc"], lambda a, b: b)
    else:
        keyed = form(batch, KEY, ORDER, "vc", 5) if form is carried.count_windows else form(batch, KEY, ORDER, "vc")
    _, changed = keyed.step(*keyed.empty())
    states = {name: materialise(keyed.step(batch, changed)[1][name]) for name in keyed.states}
    rows, after = keyed.step(batch, states)
    for df in (rows, *after.values()):
        assert df.count()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_states_of_old_snapshots_are_deleted(spark, tmp_path, readings):
    stream = replay(spark, tmp_path / "in", ROW, [readings[at : at + 43] for at in range(0, 300, 43)])
    keyed = carried.running_sums(stream, KEY, ORDER, "vc")
    carried.run_available(keyed, str(tmp_path / "run"), every=2)
    folder = tmp_path / "run" / "state" / "folds"
    assert sorted(p.name for p in (folder / "whole").iterdir()) == ["version=4", "version=6"]
    assert min(int(p.name.split("=")[1]) for p in (folder / "changes").iterdir()) == 4
    totals = rolling.grouped(spark.createDataFrame(readings, ROW), KEY, sum_vc=F.sum("vc"))
    assert bag(carried.states_after(keyed, str(tmp_path / "run"), 7, 2)["folds"], "id", "sum_vc") == bag(totals, "id", "sum_vc")


# Replay


def test_slices_are_published_in_order(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("at"), F.when(F.col("id") % 50 > 0, F.col("id")).alias("n"))
    parts = ordered_stream(df.withColumn("at", F.when(F.col("at") > 20, F.col("at"))), "at", str(tmp_path / "in"), 25)
    seen = []
    parts.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(
        lambda batch, number: seen.append([r["at"] for r in batch.collect()])
    ).start().awaitTermination()
    assert len(seen) > 20 and sum(map(len, seen)) == 1000 and seen[0].count(None) == 21
    ranges = [(min(x), max(x)) for part in seen if (x := [-1 if a is None else a for a in part])]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert not list(tmp_path.glob("in-staged*"))


# Late data


def sliced(spark, tmp_path, slice_rows=300):
    return ordered_stream(arrivals(spark, SF).drop("ts", "kind"), "batch", str(tmp_path / "in"), slice_rows)


def expected(name, columns):
    rows = database(SF).execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    return sorted(map(repr, rows))


def test_late_split_does_not_depend_on_micro_batches(spark, tmp_path):
    keyed = late.late_split(sliced(spark, tmp_path), "ts_ms", DELAY_MS, WINDOW_MS, LATENESS_MS, "batch")
    out = carried.run_available(keyed, str(tmp_path / "run"), every=2)
    columns = ["id", "seq", "batch", "window_end_ms", "wm_in", "status"]
    assert out.select("batch_id").distinct().count() > 2
    assert bag(out, *columns) == expected("late_split", columns)
    assert out.select("status").distinct().count() == 3


def test_revisions_do_not_depend_on_micro_batches(spark, tmp_path):
    folds = lambda df: [running_sum("sum_vc", F.col("vc").cast("bigint"))]
    stream = sliced(spark, tmp_path)
    keyed = late.allowed_lateness(stream, KEY, "ts_ms", DELAY_MS, WINDOW_MS, LATENESS_MS, folds, "batch")
    out = carried.run_available(keyed, str(tmp_path / "run"), every=2)
    batches = out.agg(F.max("batch_id")).first()[0] + 1
    states = carried.states_after(keyed, str(tmp_path / "run"), batches, 2)
    columns = ["id", "window_end_ms", "firing_batch", "revision", "n", "sum_vc"]
    assert bag(out.drop("batch_id").unionByName(late.close_windows(states)), *columns) == expected("allowed_lateness", columns)
    # Only windows that may still fire or change are held.
    last = arrivals(spark, SF).agg(F.max("ts_ms")).first()[0] - DELAY_MS - 1
    held = [r["window_end_ms"] for r in states["windows"].collect()]
    assert held and all(end - 1 + LATENESS_MS > last for end in held) and len(held) < 20


def test_micro_batches_as_arrivals(spark, tmp_path):
    """Without an arrival column the watermark moves between micro-batches."""
    rows = [[("k", 1_000), ("k", 61_000)], [("k", 2_000), ("k", 130_000)], [("k", 3_000), ("k", 59_999)], [("k", 400_000)]]
    stream = replay(spark, tmp_path / "in", "id string, ts_ms bigint", rows)
    keyed = late.allowed_lateness(stream, KEY, "ts_ms", 10_000, 60_000, 30_000, lambda df: [])
    out = carried.run_available(keyed, str(tmp_path / "run"))
    assert sorted(map(tuple, out.select("window_end_ms", "firing_batch", "revision", "n").collect())) == [
        (60_000, 1, 0, 2),
        (120_000, 1, 0, 1),
        (180_000, 3, 0, 1),
    ]
    split = late.late_split(replay(spark, tmp_path / "again", "id string, ts_ms bigint", rows), "ts_ms", 10_000, 60_000, 30_000)
    status = carried.run_available(split, str(tmp_path / "split")).groupBy("status").count().collect()
    assert dict(map(tuple, status)) == {eventtime.ON_TIME: 5, eventtime.DROPPED: 2}


def test_join_with_late_rows_does_not_depend_on_micro_batches(spark, tmp_path):
    left, right = joining._sides(arrivals(spark, SF), "batch", "ts_ms")
    both = ordered_stream(late.tagged(left, right, KEY, "ts_ms", "batch"), "batch", str(tmp_path / "in"), 120)
    keyed = late.interval_join_with_late(both, KEY, "left_ts", "right_ts", 3600, 3600, "ts_ms", DELAY_MS, "batch")
    out = carried.run_available(keyed, str(tmp_path / "run"), every=2)
    assert out.select("batch_id").distinct().count() > 2
    pairs, late_left, late_right = eventtime.interval_join_with_late(
        left, right, KEY, "left_ts", "right_ts", 3600, 3600, "batch", "ts_ms", DELAY_MS
    )
    found = out.select("output", "id", F.col("left.left_seq").alias("l"), F.col("right.right_seq").alias("r"), "wm_in")
    assert bag(found.where("output = 'pair'"), "id", "l", "r") == bag(pairs, "id", "left_seq", "right_seq")
    assert bag(found.where("output = 'left'"), "l", "wm_in") == bag(late_left, "left_seq", "wm_in")
    assert bag(found.where("output = 'right'"), "r", "wm_in") == bag(late_right, "right_seq", "wm_in")
    assert late_left.count() + late_right.count() > 0
    # Nothing behind watermark and bound stays.
    states = carried.states_after(keyed, str(tmp_path / "run"), out.agg(F.max("batch_id")).first()[0] + 1, 2)
    clock = states["clock"].first()
    watermark = min(clock["left_ms"], clock["right_ms"]) - DELAY_MS - 1
    assert states["rows"].where(F.col("ts_ms") + 3_600_001 < watermark).count() == 0
    assert 0 < states["rows"].count() < 60


def test_a_stream_join_has_one_store_for_each_partition(spark):
    folder = Path(urlparse(shared_dir(spark)).path)
    before = set(folder.glob("run-*"))
    assert streams.stream_window_join(spark, SF).columns
    joined = [run for run in set(folder.glob("run-*")) - before if (run / "checkpoint").exists()]
    stores = [place.name for run in joined for place in (run / "checkpoint/state/0/0").iterdir()]
    assert stores and not [name for name in stores if name.startswith(("left-", "right-"))]
