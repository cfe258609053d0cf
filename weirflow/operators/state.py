"""Per-record results of keyed state, in batch form (one output row per input row).

Each is a running fold along the arrival order, so it needs no state store and survives hot keys.
The streaming forms with real state are in ``weirflow.streaming.stateful``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.times import ordinal
from weirflow.operators.rolling import row_numbers
from weirflow.operators.running import SLICE_ROWS, running, running_max, running_top


def _latest(df: DataFrame, order: Sequence[str], *columns: str) -> Column:
    return F.struct(*[ordinal(df, c).alias(f"_o{i}") for i, c in enumerate(order)], *columns)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``prev_<column>`` of the key's preceding record (null at the first)."""
    folds = [running_max("_prev", _latest(df, order, *columns), before=True)]
    out = running(df, keys, order, folds, slice_rows)
    return out.withColumns({f"prev_{c}": F.col(f"_prev.{c}") for c in columns}).drop("_prev")


def jumps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, limit: int, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Records that differ from the key's last one by more than ``limit`` (the first is compared with 0)."""
    out = previous(df, keys, order, [value], slice_rows)
    last = F.coalesce(F.col(f"prev_{value}"), F.lit(0))
    return out.withColumn(f"prev_{value}", last).where(F.abs(F.col(value) - F.col(f"prev_{value}")) > limit)


def top_so_far(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int = 3, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    return running_top(df, keys, order, value, k, "top", slice_rows)


def value_counts_so_far(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The entry of the key's value-to-count map that each record changes, after the change."""
    return row_numbers(df, [*keys, value], order, "n", slice_rows)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The final value-to-count map, one row per entry."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def last_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    ttl_seconds: int,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The key's last value if it was written less than ``ttl_seconds`` ago in event time, else 0.

    The streaming form expires state by processing time; this one is its event-time counterpart.
    """
    ts = order[0]
    dated = df.withColumn("_at", ordinal(df, ts))
    out = previous(dated, keys, order, ["_at", value], slice_rows)
    alive = F.col("_at") - F.col("prev__at") < F.lit(ttl_seconds * 1_000_000)
    last = F.when(alive, F.col(f"prev_{value}")).otherwise(F.lit(0))
    return out.withColumn(f"last_{value}", last).drop("_at", "prev__at", f"prev_{value}")


def record_counter(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Number of earlier records of the key: 0, 1, 2, ..."""
    numbered = row_numbers(df, keys, order, "counter", slice_rows)
    return numbered.withColumn("counter", F.col("counter") - 1)


def in_force(
    data: DataFrame,
    control: DataFrame,
    ts: str,
    control_ts: str,
    control_seq: str,
    setting: str,
    keys: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Data rows with the latest ``setting`` of the control table at or before their time.

    The control table is not broadcast and may be of any size: both are put on one time line
    (per key, if keys are given) and the latest control row is carried along it.
    """
    group = list(keys) or ["_all"]
    # Rows of one instant are told apart by a hash, so that an instant with very many can be cut too.
    tie = F.xxhash64(*[c for c, kind in data.dtypes if "map<" not in kind])
    rows = data.withColumns({"_row": F.struct(*data.columns), "_at": ordinal(data, ts), "_side": F.lit(1), "_tie": tie})
    changes = control.withColumns({"_at": ordinal(control, control_ts), "_side": F.lit(0), "_tie": F.lit(0).cast("bigint")})
    change = F.struct(F.col("_at"), ordinal(control, control_seq).alias("_seq"), F.col(setting).alias("_setting"))
    if not keys:
        rows, changes = rows.withColumn("_all", F.lit(0)), changes.withColumn("_all", F.lit(0))
    line = rows.select(*group, "_at", "_side", "_tie", "_row").unionByName(
        changes.select(*group, "_at", "_side", "_tie", change.alias("_change")), allowMissingColumns=True
    )
    carried = running(line, group, ["_at", "_side", "_tie"], [running_max("_latest", F.col("_change"))], slice_rows)
    return carried.where(F.col("_side") == 1).select("_row.*", F.col("_latest._setting").alias(setting))


def above_threshold(
    data: DataFrame,
    control: DataFrame,
    ts: str,
    value: str,
    control_ts: str,
    control_seq: str,
    threshold: str = "threshold",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Data rows whose value exceeds the threshold in force (0 until the first is set)."""
    out = in_force(data, control, ts, control_ts, control_seq, threshold, (), slice_rows)
    out = out.withColumn(threshold, F.coalesce(F.col(threshold), F.lit(0)))
    return out.where(F.col(value) > F.col(threshold))
