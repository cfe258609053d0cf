"""Session helpers: a local builder for tests and benches, and the shared folder lookup."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches. On a cluster, pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weirflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_keyed_state_store(spark: SparkSession) -> None:
    """Choose the state store that keyed state with timers requires (before a query starts)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # Commit small changelogs per micro-batch instead of whole snapshots.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def use_joint_state_store(spark: SparkSession) -> None:
    """Keep the state of a stream join in one keyed store for each partition (before a query starts).

    By default it is in four, and each of them writes files in every micro-batch, however few its rows are.
    """
    use_keyed_state_store(spark)
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediate tables.

    It is the folder set with ``setCheckpointDir``, else the cluster's ``spark.checkpoint.dir``. With
    neither, a local master (tests, a laptop) gets a temporary folder, once per session; on a cluster
    executors would not see it, so that is an error.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    chosen = spark.conf.get("weirflow.checkpoint.dir", None)
    if not chosen:
        chosen = tempfile.mkdtemp(prefix="weirflow-")
        spark.conf.set("weirflow.checkpoint.dir", chosen)
    return chosen


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder with a reliable checkpoint and read it from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def broadcast_if_small(written: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a table for a broadcast join only after its rows have been counted and measured.

    ``written`` should come from :func:`materialise`, so that counting it is cheap. Beyond
    ``max_rows`` rows, or ``max_bytes`` of text of all its columns, it is returned without a hint and
    Spark plans a shuffled join (with AQE skew splitting).
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in written.columns]))
    few = written.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(row)).alias("b")).first()
    return F.broadcast(written) if few["n"] <= max_rows and (few["b"] or 0) <= max_bytes else written
