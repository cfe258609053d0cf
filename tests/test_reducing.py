"""General reducers: functions that are not commutative, over hot keys, in windows and over micro-batches."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.replay import replay
from weirflow.operators import reducing
from weirflow.streaming import carried

ROW = "id string, ts bigint, seq bigint, word string"
ORDER = ["ts", "seq"]
MODULUS = 1_000_003


def joined(a, b):
    return ((a[0] or "") + (b[0] or ""),)


def product(a, b):
    """2 x 2 matrices."""
    return (
        (a[0] * b[0] + a[1] * b[2]) % MODULUS,
        (a[0] * b[1] + a[1] * b[3]) % MODULUS,
        (a[2] * b[0] + a[3] * b[2]) % MODULUS,
        (a[2] * b[1] + a[3] * b[3]) % MODULUS,
    )


def rows(n, keys=("hot", "hot", "hot", None, "a", "b")):
    rng = random.Random(5)
    return [(rng.choice(keys), None if k < 4 else k // 5, k, rng.choice([None, "x", "yz", "", "é"])) for k in range(n)]


def by_key(of):
    groups = {}
    for row in of:
        groups.setdefault(row[0], []).append(row)
    return groups


def brute(of):
    out = {}
    for group in by_key(of).values():
        for row, held in zip(group, accumulate([(r[3],) for r in group], joined)):
            out[row[2]] = held[0]
    return out


@pytest.mark.parametrize("slice_rows", [15, 10_000])
def test_running_text_joins_match_brute_force(spark, slice_rows):
    given = rows(240)
    df = spark.createDataFrame(given, ROW).withColumn("extra", F.current_timestamp())
    out = reducing.running_reduce(df, ["id"], ORDER, ["word"], joined, slice_rows=slice_rows)
    assert out.columns == ["id", "ts", "seq", "word", "extra", "reduced_word"]
    assert {r["seq"]: r["reduced_word"] for r in out.collect()} == brute(given)


@pytest.mark.parametrize("slice_rows", [50, 10_000])
def test_matrix_products_of_a_hot_key(spark, slice_rows):
    rng = random.Random(2)
    given = [("k", n, *(rng.randrange(MODULUS) for _ in range(4))) for n in range(400)]
    df = spark.createDataFrame(given, "id string, seq bigint, a bigint, b bigint, c bigint, d bigint").repartition(5)
    out = reducing.running_reduce(df, ["id"], ["seq"], ["a", "b", "c", "d"], product, slice_rows=slice_rows)
    expected = list(accumulate([r[2:] for r in given], product))
    assert [tuple(r)[6:] for r in out.orderBy("seq").collect()] == expected
    total = reducing.reduce_groups(df, ["id"], ["seq"], ["a", "b", "c", "d"], product, slice_rows)
    assert [tuple(r) for r in total.collect()] == [("k", *expected[-1])]


def test_windows_are_reduced_in_order(spark):
    given = rows(200, ("hot",))
    df = spark.createDataFrame(given, ROW).where("ts is not null").withColumn("at", F.timestamp_seconds("ts"))
    out = reducing.window_reduce(df, ["id"], "at", "10 seconds", ORDER, ["word"], joined, slice_rows=12).collect()
    expected = {}
    for _, ts, _, word in given:
        if ts is not None:
            expected[ts // 10] = expected.get(ts // 10, "") + (word or "")
    assert {int(r["window_start"].timestamp()) // 10: r["word"] or "" for r in out} == expected


@pytest.mark.parametrize("slice_rows", [20, 10_000])
def test_reduce_over_micro_batches(spark, tmp_path, slice_rows):
    given = rows(200)
    stream = replay(spark, tmp_path / "in", ROW, [given[:90], given[90:95], given[95:]])
    keyed = carried.reduced_by(stream, ["id"], ORDER, ["word"], joined, slice_rows)
    out = carried.run_available(keyed, str(tmp_path / "run"))
    assert {r["seq"]: r["reduced_word"] for r in out.collect()} == brute(given)


def test_empty_and_single_records(spark):
    df = spark.createDataFrame([], ROW)
    assert reducing.running_reduce(df, ["id"], ORDER, ["word"], joined).count() == 0
    assert reducing.reduce_groups(df, ["id"], ORDER, ["word"], joined).count() == 0
    one = spark.createDataFrame([(None, None, 1, None)], ROW)
    assert reducing.reduce_groups(one, ["id"], ORDER, ["word"], joined).collect() == [(None, None)]
