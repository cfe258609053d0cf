"""Sessions and settings over micro-batches of unordered rows, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tests.replay import replay
from weirflow.operators.running import running_sum
from weirflow.streaming import carried, sessions

ROW = "id string, ts timestamp, seq bigint, gap int"
DELAY = 40


def disordered(spark, n, keys=("hot", "hot", "hot", None, "a")):
    """Rows in the order of arrival, up to ``DELAY`` seconds after their time."""
    rng = random.Random(9)
    rows = [(rng.choice(keys), rng.randrange(600), seq, rng.choice([0, 0, 1, 3, 9])) for seq in range(n)]
    return sorted(rows, key=lambda r: r[1] + rng.randrange(DELAY))


def plain_sessions(rows):
    out = {}
    for key, at, _, gap in sorted(rows, key=lambda r: (r[0] or "", r[1], r[1] + r[3])):
        found = out.setdefault(key, [])
        if found and at <= found[-1][1]:
            last = found[-1]
            found[-1] = (last[0], max(last[1], at + gap), at, last[3] + 1)
        else:
            found.append((at, at + gap, at, 1))
    return sorted((repr(key), *s) for key, found in out.items() for s in found)


def timed(spark, tmp_path, rows, parts):
    """Micro-batches, with times made from seconds."""
    stream = replay(spark, tmp_path / "in", "id string, at bigint, seq bigint, gap int", [rows[a:b] for a, b in parts])
    return stream.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def seconds(df):
    return [F.floor(F.col(c) / 1_000_000).alias(c) for c in ("start_us", "end_us", "last_us")]


@pytest.mark.parametrize("slice_rows", [10, 1_000])
def test_sessions_of_unordered_rows(spark, tmp_path, slice_rows):
    rows = disordered(spark, 150)
    stream = timed(spark, tmp_path, rows, [(0, 60), (60, 61), (61, 150)])
    keyed = sessions.event_sessions(stream, ["id"], "ts", F.col("gap"), lambda df: [running_sum("n", F.lit(1).cast("bigint"))], DELAY, slice_rows)
    out = carried.run_available(keyed, str(tmp_path / "run"), every=2)
    states = carried.states_after(keyed, str(tmp_path / "run"), 3, 2)
    every = out.drop("batch_id").unionByName(sessions.open_sessions(states))
    found = sorted((repr(r["id"]), r["start_us"], r["end_us"], r["last_us"], r["n"]) for r in every.select("id", *seconds(every), "n").collect())
    assert found == plain_sessions(rows)
    assert out.where("batch_id = 0").count() > 0 and any(s[1] == s[2] for s in found)
    # Only sessions that a record on time may still reach are held.
    newest = max(r[1] for r in rows)
    held = [r["end_us"] // 1_000_000 for r in states["sessions"].collect()]
    assert held and all(end >= newest - DELAY for end in held)


def test_settings_are_looked_up_by_event_time(spark, tmp_path):
    rows = disordered(spark, 120)
    stream = timed(spark, tmp_path, rows, [(0, 50), (50, 51), (51, 120)])
    control = F.col("gap") == 9
    keyed = sessions.in_force(stream, F.lit(True), control, "ts", "seq", F.col("seq"), "setting", DELAY)
    out = {r["seq"]: r["setting"] for r in carried.run_available(keyed, str(tmp_path / "run"), every=2).collect()}
    settings = sorted((at, seq) for _, at, seq, gap in rows if gap == 9)

    def expected(at, seen):
        before = [s for s in settings if s[0] <= at and s[1] in seen]
        return before[-1][1] if before else None

    seen = set()
    for a, b in [(0, 50), (50, 51), (51, 120)]:
        seen |= {r[2] for r in rows[a:b]}
        for _, at, seq, _ in rows[a:b]:
            assert out[seq] == expected(at, seen)
    log = carried.states_after(keyed, str(tmp_path / "run"), 3, 2)["log"]
    newest = max(r[1] for r in rows)
    kept = sorted(int(r["_from"].timestamp()) for r in log.collect())
    assert len(kept) < len(settings) and all(at > newest - DELAY for at in kept[1:])


def test_empty_micro_batches_change_nothing(spark, tmp_path):
    keyed = sessions.event_sessions(
        spark.createDataFrame([], ROW), ["id"], "ts", 5, lambda df: [running_sum("n", F.lit(1).cast("bigint"))], DELAY
    )
    carried.process(keyed, spark.createDataFrame([], ROW), 0, str(tmp_path / "run"))
    assert carried.states_after(keyed, str(tmp_path / "run"), 1)["sessions"].count() == 0
