"""Streams over a table in many shuffled files, and numbers, keys and folders that went wrong once."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, database
from weirflow import session
from weirflow.operators import project, rolling, route, windows
from weirflow.plans import streams
from weirflow.plans.registry import QUERIES, SQL
from weirflow.sources.replay import ordered_stream
from weirflow.sources.records import parse_records
from weirflow.streaming import runs, stateful

SF = "/root/testdata/sf0.001"
ANY_LAYOUT = [
    "stream_tumbling_count", "stream_session_fixed", "stream_interval_join", "stream_top_of_windows",
    "stream_running_sum", "stream_map_counts", "stream_count_window_sliding", "stream_alert_outputs",
]


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("many")
    spark.read.parquet(f"{SF}/events.parquet").repartition(130, F.rand(3)).write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ANY_LAYOUT)
def test_result_does_not_depend_on_files(spark, many_files, name):
    problem, rows = compare(spark, database(SF), QUERIES[name], SQL[name], many_files)
    assert problem is None and rows > 0


def test_replay_in_slices_of_time(spark, many_files, tmp_path):
    readings = streams._readings(spark.read.parquet(f"{many_files}/events.parquet"))
    stream = ordered_stream(readings, "ts", str(tmp_path / "replay"), 200)
    out = runs.run_available(stateful.running_sum(stream, ["id"], ["ts", "seq"], "vc"))
    assert out.select("batch_id").distinct().count() > 2
    twin = rolling.rolling_sum(readings, ["id"], ["ts", "seq"], "vc").select("id", "seq", "sum_vc")
    assert sorted(map(tuple, out.drop("batch_id").collect())) == sorted(map(tuple, twin.collect()))


def test_no_window_loses_rows(spark, many_files):
    assert QUERIES["stream_tumbling_count"](spark, many_files).agg(F.sum("n")).first()[0] == 1000


def test_fractions_and_decimals_are_not_cut(spark):
    rows = [("k", 1, 0.5, Decimal("0.90")), ("k", 2, 0.25, Decimal("0.90")), ("k", 3, None, None)]
    df = spark.createDataFrame(rows, "id string, seq bigint, d double, m decimal(10,2)")
    sums = rolling.rolling_sum(df, ["id"], ["seq"], "m").orderBy("seq")
    assert [r["sum_m"] for r in sums.collect()] == [Decimal("0.90"), Decimal("1.80"), Decimal("1.80")]
    means = rolling.rolling_average(df, ["id"], ["seq"], "d").orderBy("seq")
    assert [r["avg_d"] for r in means.collect()] == [0.5, 0.375, 0.375]
    timed = df.withColumn("ts", F.timestamp_seconds("seq"))
    assert windows.window_reduce(timed, ["id"], "ts", "1 hour", ["seq"], "m").first()["sum_m"] == Decimal("1.80")


def test_null_is_no_extreme(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, 4), ("k", 3, 3)], "id string, seq bigint, vc int")
    out = rolling.rolling_extreme_by(df, ["id"], ["seq"], "vc", ["seq"], largest=False).orderBy("seq")
    assert [r["best_seq"] for r in out.collect()] == [None, 2, 3]


def test_large_keys_beside_null_keys_stay_exact(spark):
    df = spark.createDataFrame([(9007199254740993, 1), (None, 2), (9007199254740993, 3)], "id bigint, vc int")
    total = lambda column: lambda groups: groups[[column]].sum()
    out = rolling.user_aggregate(
        df, ["id"], lambda g: g[["vc"]].sum().rename(columns={"vc": "t"}), total("t"), lambda a: a[["t"]], "t bigint", "t bigint"
    )
    assert {(r["id"], r["t"]) for r in out.collect()} == {(9007199254740993, 4), (None, 2)}


def test_failfast_does_not_depend_on_ansi(spark):
    lines = spark.createDataFrame([("s1,x,1",)], "value string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad line"):
            parse_records(lines).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_main_output_stays_whole(spark):
    df = spark.createDataFrame([(1, 5), (2, 20)], "seq bigint, vc int")
    out = route.beside_main(df, {"alert": F.col("vc") > 10})
    assert sorted((r["seq"], r["tag"]) for r in out.collect()) == [(1, "main"), (2, "alert"), (2, "main")]


def test_opaque_flat_map(spark):
    df = spark.createDataFrame([("a b",), ("c",), (None,)], "line string")
    words = lambda row: [] if row["line"] is None else [(w,) for w in row["line"].split()]
    assert sorted(r["word"] for r in project.flat_map_with(df, words, "word string").collect()) == ["a", "b", "c"]


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, master, folder=None, **conf):
        self.sparkContext, self.conf = _Context(master, folder), self
        self.values = conf

    def get(self, key, default):
        return self.values.get(key.replace(".", "_"), default)

    def set(self, key, value):
        self.values[key.replace(".", "_")] = value


def test_shared_folder():
    assert session.shared_dir(_Session("yarn", "hdfs://n/c", spark_checkpoint_dir="hdfs://n/d")) == "hdfs://n/c"
    assert session.shared_dir(_Session("yarn", spark_checkpoint_dir="hdfs://n/d")) == "hdfs://n/d"
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(ValueError):
        session.shared_dir(_Session("spark://host:7077"))
