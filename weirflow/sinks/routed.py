"""Several outputs from one streaming pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery


def start_routed_sink(
    routed: DataFrame,
    path: str,
    checkpoint: str,
    column: str = "tag",
    format: str = "parquet",
    output_mode: str = "append",
) -> StreamingQuery:
    """Write each tag's rows to its own directory ``path/batch_id=<n>/<column>=<tag>``.

    Every tag that turns up gets one, so no row is lost, and a micro-batch is written in one pass. A
    replayed batch overwrites its own directory, which makes the writes idempotent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(column).format(format).save(f"{path}/batch_id={batch_id}")

    return (
        routed.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def routed_output(
    spark: SparkSession, routed: DataFrame, path: str, tag: str | None = None, column: str = "tag", format: str = "parquet"
) -> DataFrame:
    """What :func:`start_routed_sink` has written of ``routed``: the rows of one tag, or all with their tags."""
    rows = [f for f in routed.schema.fields if f.name != column]
    places = [T.StructField("batch_id", T.LongType()), T.StructField(column, T.StringType())]
    written = spark.read.schema(T.StructType(rows + places)).format(format).load(path).drop("batch_id")
    return written if tag is None else written.where(F.col(column) == tag).drop(column)
