"""Files that roll by bytes, and windows by a clock of processing time."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.replay import replay
from weirflow.sinks.files import file_numbers, start_rolled_sink, write_rolled
from weirflow.sources.replay import paced_stream
from weirflow.streaming import runs, windows

SCHEMA = "value string, seq bigint, bucket string"
LIMIT = 100


def lines(n=200):
    rng = random.Random(2)
    words = ["", "é" * 9, "x" * 30, "many words in one line", "y" * 250]
    return [(rng.choice(words), seq, rng.choice(["a", "a", "b", None])) for seq in range(n)]


def size(value):
    return len((value or "").encode()) + 1


def plain_files(rows, limit=LIMIT):
    """The lines of each file: a new one begins where a line starts beyond the limit of the one before."""
    out, before = {}, {}
    for value, seq, bucket in sorted(rows, key=lambda r: r[1]):
        at = before.get(bucket, 0)
        out.setdefault((bucket, at // limit), []).append(value or "")
        before[bucket] = at + size(value)
    return out


def read_files(folder):
    return sorted(p.read_text().split("\n")[:-1] for p in Path(folder).rglob("part-*.txt"))


@pytest.mark.parametrize("slice_rows", [20, 10_000])
def test_files_hold_whole_lines_up_to_the_limit(spark, tmp_path, slice_rows):
    rows = lines()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, F.rand(1))
    write_rolled(df, str(tmp_path / "out"), ["seq"], LIMIT, "bucket", slice_rows)
    expected = plain_files(rows)
    assert read_files(tmp_path / "out") == sorted(expected.values())
    longest = max(size(r[0]) for r in rows)
    assert all(sum(map(size, found)) <= LIMIT + longest for found in expected.values())
    # Written again it replaces what was there.
    write_rolled(df, str(tmp_path / "out"), ["seq"], LIMIT, "bucket", slice_rows)
    assert read_files(tmp_path / "out") == sorted(expected.values())


def test_numbers_without_buckets_and_of_an_empty_table(spark, tmp_path):
    rows = [("ab", 1, None), (None, 2, None), ("é", 3, None), ("abcd", 4, None)]
    numbered = file_numbers(spark.createDataFrame(rows, SCHEMA), "value", ["seq"], 4).orderBy("seq").collect()
    assert [(r["file_no"], r["file_bytes"]) for r in numbered] == [(0, 0), (0, 3), (1, 4), (1, 7)]
    write_rolled(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), ["seq"], 4)
    assert read_files(tmp_path / "none") in ([], [[]])


def test_rolled_sink_closes_files_with_each_micro_batch(spark, tmp_path):
    rows = lines(60)
    stream = replay(spark, tmp_path / "in", SCHEMA, [rows[:25], rows[25:]]).drop("bucket")
    for _ in range(2):  # nothing is doubled by a second start
        start_rolled_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["seq"], LIMIT, None).awaitTermination()
    flat = [[(v, s, None) for v, s, _ in part] for part in (rows[:25], rows[25:])]
    assert read_files(tmp_path / "out") == sorted(found for part in flat for found in plain_files(part).values())


@pytest.mark.parametrize("slice_rows", [7, 1_000])
def test_windows_by_a_clock_do_not_depend_on_micro_batches(spark, tmp_path, slice_rows):
    rows = [(random.Random(seq).choice(["a", "b", None]), seq) for seq in range(60)]
    df = spark.createDataFrame(rows, "id string, seq bigint").repartition(3, F.rand(1))
    stream = paced_stream(df, ["seq"], str(tmp_path / "in"), 4, 100, slice_rows=slice_rows, cut_rows=16)

    def build(s):
        return windows.processing_windows(s, ["id"], "5 seconds", clock=F.col("pt"), n=F.count(F.lit(1)))

    out = runs.run_to_end(stream, "pt", build, str(tmp_path / "run"))
    expected = {}
    for key, seq in rows:
        start = (100 + seq // 4) // 5 * 5
        expected[key, start] = expected.get((key, start), 0) + 1
    assert {(r["id"], int(r["window_start"].timestamp())): r["n"] for r in out.collect()} == expected
