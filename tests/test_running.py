"""Running folds against brute force, with and without hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators import rolling, state, windows
from weirflow.operators.running import running_max, running_sum, running, slice_hot_keys

KEY, ORDER = ["id"], ["at", "seq"]


def readings(rows_per_shape: int = 400) -> list[tuple]:
    """(id, at, seq, vc); in each shape of time line one key holds most rows."""
    rng = random.Random(11)
    out = []
    for shape in ("even", "burst", "ties", "mixed"):
        for i in range(rows_per_shape):
            seq = len(out)
            at = {
                "even": i,
                "burst": 1_000 + i if rng.random() < 0.9 else i * 100_000,
                "ties": 7,
                "mixed": rng.choice([5, 5, 5, rng.randrange(10_000)]),
            }[shape]
            key = "hot" if rng.random() < 0.7 else rng.choice("abcdefgh")
            out.append((f"{shape}-{key}", at, seq, rng.randrange(-20, 60)))
    rng.shuffle(out)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, at bigint, seq bigint, vc int")


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


LIMITS = pytest.mark.parametrize("slice_rows", [20, 10_000])


def test_hot_keys_are_cut_into_bounded_slices(spark):
    rows = readings()
    sliced = slice_hot_keys(table(spark, rows), KEY, ORDER, 20)
    sizes = sliced.df.groupBy(*sliced.group).count().collect()
    assert sum(r["count"] for r in sizes) == len(rows)
    assert max(r["count"] for r in sizes) <= 20
    last = {}
    for r in sliced.df.orderBy("id", *ORDER).collect():
        number = tuple(r[c] for c in sliced.slices)
        assert last.get(r["id"], number) <= number
        last[r["id"]] = number


def test_no_hot_key_means_a_plain_window(spark):
    sliced = slice_hot_keys(table(spark, readings()), KEY, ORDER)
    assert sliced.slices == ()


@LIMITS
def test_sum_lag_and_average(spark, slice_rows):
    rows = readings()
    df = table(spark, rows)
    sums = rolling.rolling_sum(df, KEY, ORDER, "vc", first_of=["vc"], slice_rows=slice_rows)
    lags = state.previous(df, KEY, ORDER, ["vc"], slice_rows)
    averages = rolling.rolling_average(df, KEY, ORDER, "vc", slice_rows)
    got_sum = {r["seq"]: (r["sum_vc"], r["first_vc"]) for r in sums.collect()}
    got_lag = {r["seq"]: r["prev_vc"] for r in lags.collect()}
    got_avg = {r["seq"]: r["avg_vc"] for r in averages.collect()}
    assert len(got_sum) == len(rows)
    for group in by_key(rows).values():
        total, previous = 0, None
        for n, (_, _, seq, vc) in enumerate(group, 1):
            total += vc
            assert got_sum[seq] == (total, group[0][3])
            assert got_lag[seq] == previous
            assert got_avg[seq] == total / n
            previous = vc


@LIMITS
@pytest.mark.parametrize("largest", [True, False])
def test_extreme_and_its_record(spark, slice_rows, largest):
    rows = readings()
    df = table(spark, rows)
    out = rolling.rolling_extreme_by(df, KEY, ORDER, "vc", ["vc", "seq"], largest, slice_rows)
    plain = rolling.rolling_extreme(df, KEY, ORDER, "vc", ["seq"], largest, slice_rows)
    got = {r["seq"]: (r["best_vc"], r["best_seq"]) for r in out.collect()}
    got_plain = {r["seq"]: (r["best_vc"], r["first_seq"]) for r in plain.collect()}
    for group in by_key(rows).values():
        best = None
        for row in group:
            if best is None or (row[3] > best[3] if largest else row[3] < best[3]):
                best = row
            assert got[row[2]] == (best[3], best[2])
            assert got_plain[row[2]] == (best[3], group[0][2])


@LIMITS
def test_top_three(spark, slice_rows):
    rows = readings()
    out = state.top_so_far(table(spark, rows), KEY, ORDER, "vc", 3, slice_rows)
    got = {r["seq"]: r["top"] for r in out.collect()}
    for group in by_key(rows).values():
        seen = []
        for row in group:
            seen.append(row[3])
            assert got[row[2]] == sorted(seen, reverse=True)[:3]


@LIMITS
@pytest.mark.parametrize("size,slide", [(5, None), (5, 2), (3, 4), (2, 5), (4, 4)])
def test_count_windows(spark, slice_rows, size, slide):
    rows = readings()
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_rn", "seq"))), lambda x: x["seq"])
    out = windows.count_windows(table(spark, rows), KEY, ORDER, size, slide, slice_rows, members=listed)
    got = {(r["id"], r["window_no"]): (r["n"], r["members"]) for r in out.collect()}
    expected = {}
    for key, group in by_key(rows).items():
        step = slide or size
        for end in range(step, len(group) + 1, step):
            members = [r[2] for r in group[max(0, end - size) : end]]
            expected[(key, end // step)] = (len(members), members)
    assert got == expected


@LIMITS
@pytest.mark.parametrize("gap", ["fixed", "dynamic"])
def test_sessions(spark, slice_rows, gap):
    rows = readings()
    df = table(spark, rows).withColumn("at", F.timestamp_seconds("at"))
    length = F.lit(3) if gap == "fixed" else F.greatest(F.col("vc"), F.lit(0))
    out = windows.session_windows(df, KEY, ORDER, length, slice_rows, n=F.count(F.lit(1)))
    got = sorted(
        (r["id"], int(r["session_start"].timestamp()), int(r["session_end"].timestamp()), r["n"])
        for r in out.collect()
    )
    expected = []
    for key, group in by_key(rows).items():
        current = None
        for _, at, _, vc in group:
            end = at + (3 if gap == "fixed" else max(vc, 0))
            if current is None or at > current[1]:
                if current:
                    expected.append((key, *current))
                current = (at, end, 1)
            else:
                current = (current[0], max(current[1], end), current[2] + 1)
        expected.append((key, *current))
    assert got == sorted(expected)


@LIMITS
def test_global_window_trigger(spark, slice_rows):
    rows = readings()
    folds = [running_sum("total", F.col("vc").cast("bigint"))]
    out = windows.global_window(table(spark, rows), KEY, ORDER, lambda n: n % 4 == 0, folds, slice_rows)
    got = {r["seq"]: (r["n"], r["total"]) for r in out.collect()}
    expected = {}
    for group in by_key(rows).values():
        for n, row in enumerate(group, 1):
            if n % 4 == 0:
                expected[row[2]] = (n, sum(r[3] for r in group[:n]))
    assert got == expected


@LIMITS
def test_setting_in_force(spark, slice_rows):
    rows = readings()
    control = [(at + 1, seq, vc) for _, at, seq, vc in rows if seq % 5 == 0]
    changes = spark.createDataFrame(control, "from_at bigint, from_seq bigint, threshold int")
    out = state.in_force(table(spark, rows), changes, "at", "from_at", "from_seq", "threshold", (), slice_rows)
    got = {r["seq"]: r["threshold"] for r in out.collect()}
    assert len(got) == len(rows)
    for _, at, seq, _ in rows:
        known = [c for c in control if c[0] <= at]
        assert got[seq] == (max(known)[2] if known else None)


def test_null_keys_are_cut(spark):
    rows = [(None if i % 2 else "k", i, i, 1) for i in range(100)]
    df = table(spark, rows)
    out = running(df, KEY, ORDER, [running_sum("n", F.lit(1)), running_max("m", F.col("seq"))], 10)
    got = {r["seq"]: (r["n"], r["m"]) for r in out.collect()}
    assert got == {i: (i // 2 + 1, i) for i in range(100)}
    assert largest_slice(df, ORDER) <= 10


def largest_slice(df, order, slice_rows=10):
    sliced = slice_hot_keys(df, KEY, order, slice_rows)
    return sliced.df.groupBy(*sliced.group).count().agg(F.max("count")).first()[0]


def test_three_order_columns(spark):
    rows = [("k", 7, (i * 37) % 10, i, 1) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, at bigint, part bigint, seq bigint, vc int")
    out = running(df, KEY, ["at", "part", "seq"], [running_sum("n", F.lit(1))], 10)
    ranks = {row[3]: n for n, row in enumerate(sorted(rows, key=lambda r: r[1:4]), 1)}
    assert {r["seq"]: r["n"] for r in out.collect()} == ranks
    assert largest_slice(df, ["at", "part", "seq"]) <= 10


@pytest.mark.parametrize("times", ["exponential", "burst", "nulls"])
def test_slices_stay_within_the_limit(spark, times):
    at = {"exponential": lambda i: 2 ** (i // 8), "burst": lambda i: 5 if i < 200 else i, "nulls": lambda i: None if i < 150 else i}[times]
    rows = [("k", at(i), i, 1) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, at bigint, seq bigint, vc int")
    out = running(df, KEY, ORDER, [running_sum("n", F.lit(1))], 20)
    assert {r["seq"]: r["n"] for r in out.collect()} == {i: i + 1 for i in range(400)}
    assert largest_slice(df, ORDER, 20) <= 20
