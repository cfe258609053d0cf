"""Data stream checked against settings that another input changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def latest_setting(control: DataFrame, setting: str, seq: str, default):
    """The newest setting of a control table (one value), or the default while it is empty."""
    newest = control.agg(F.max_by(setting, seq).alias("newest")).first()["newest"]
    return default if newest is None else newest


def start_threshold_alerts(
    data: DataFrame,
    read_control: Callable[[], DataFrame],
    value: str,
    path: str,
    checkpoint: str,
    setting: str = "threshold",
    seq: str = "seq",
    default: int = 0,
) -> StreamingQuery:
    """Write the rows above the threshold in force when their micro-batch is processed.

    ``read_control`` returns the control table as it is now; it is read once per micro-batch and
    only its newest value reaches the tasks. The data side cannot change it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        threshold = latest_setting(read_control(), setting, seq, default)
        alerts = batch.where(F.col(value) > threshold).withColumn(setting, F.lit(threshold))
        alerts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        data.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
