"""Full windows of streams, against the batch form and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tests.replay import replay
from weirflow.operators import windows
from weirflow.streaming import carried, elements

SCHEMA = "id string, at bigint, seq bigint, vc int"
SIZE, DELAY, PAGE = 60, 40, 7


def rows_of_a_day(n=240):
    """Rows in the order of arrival, at most ``DELAY`` seconds late; most have one key, some none and no time."""
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", None, "a"]), rng.randrange(600), seq, rng.choice([None, 1, 2])) for seq in range(n)]
    rows = sorted(rows, key=lambda r: r[1] + rng.randrange(DELAY))
    return [(k, None, seq, v) if seq % 50 == 0 else (k, at, seq, v) for k, at, seq, v in rows]


def plain_pages(rows):
    groups = {}
    for key, at, seq, vc in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
        groups.setdefault((key, at // SIZE * SIZE), []).append(vc)
    return sorted(
        repr((key, start, page, len(found), found[page * PAGE : (page + 1) * PAGE]))
        for (key, start), found in groups.items()
        for page in range(-(-len(found) // PAGE))
    )


def shown(df):
    return sorted(repr((r["id"], int(r["window_start"].timestamp()), r["page"], r["n"], r["elements"])) for r in df.collect())


def timed(df):
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def run(spark, folder, rows, parts, slice_rows=1_000):
    stream = timed(replay(spark, folder / "in", SCHEMA, [rows[a:b] for a, b in parts]))
    keyed = elements.window_elements(stream, ["id"], "ts", SIZE, ["ts", "seq"], F.col("vc"), DELAY, PAGE, slice_rows)
    out = carried.run_available(keyed, str(folder / "run"), every=2)
    states = carried.states_after(keyed, str(folder / "run"), len(parts), 2)
    return out, states, elements.open_windows(keyed, states, ["id"], "ts", SIZE, ["ts", "seq"], PAGE)


@pytest.mark.parametrize("slice_rows", [25, 1_000])
def test_every_window_comes_once_and_whole(spark, tmp_path, slice_rows):
    rows = rows_of_a_day()
    out, states, left = run(spark, tmp_path, rows, [(0, 90), (90, 150), (150, 240)], slice_rows)
    assert shown(out.drop("batch_id").unionByName(left)) == plain_pages(rows)
    assert out.select("batch_id").distinct().count() >= 2
    # Only rows of windows that may still get others are held.
    newest = max(r[1] for r in rows if r[1] is not None)
    assert all(r["_end_us"] > (newest - DELAY) * 1_000_000 for r in states["rows"].collect())
    assert max(len(r["elements"]) for r in out.collect()) == PAGE


def test_late_rows_are_in_no_page(spark, tmp_path):
    rows = [("a", 10, 1, 1), ("a", 200, 2, 2), ("a", 20, 3, 3), ("a", 210, 4, 4)]
    out, _, left = run(spark, tmp_path, rows, [(0, 2), (2, 4)])
    assert shown(out) == [repr(("a", 0, 0, 1, [1]))]
    assert shown(left) == [repr(("a", 180, 0, 2, [2, 4]))]


def test_a_repeated_micro_batch_gives_the_same(spark, tmp_path):
    rows, folder = rows_of_a_day(90), str(tmp_path / "run")
    df = timed(spark.createDataFrame(rows, SCHEMA))
    keyed = elements.window_elements(df, ["id"], "ts", SIZE, ["ts", "seq"], F.col("vc"), DELAY, PAGE)
    for number in (0, 1, 1, 2):
        part = timed(spark.createDataFrame(rows[number * 30 : (number + 1) * 30], SCHEMA))
        carried.process(keyed, part, number, folder, every=2)
    left = elements.open_windows(keyed, carried.states_after(keyed, folder, 3, 2), ["id"], "ts", SIZE, ["ts", "seq"], PAGE)
    assert shown(carried.written(keyed, folder).drop("batch_id").unionByName(left)) == plain_pages(rows)


def test_batch_windows_of_null_keys_and_hot_keys(spark):
    rows = rows_of_a_day()
    df = timed(spark.createDataFrame(rows, SCHEMA)).where("ts is not null")
    for slice_rows in (25, 1_000):
        out = windows.window_elements(df, ["id"], "ts", f"{SIZE} seconds", ["ts", "seq"], F.col("vc"), PAGE, slice_rows)
        assert shown(out) == plain_pages(rows)


def test_counting_needs_no_second_shuffle(spark):
    df = timed(spark.createDataFrame(rows_of_a_day(), SCHEMA))
    out = windows.window_elements(df, ["id"], "ts", f"{SIZE} seconds", ["ts", "seq"], F.col("vc"), PAGE)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
