"""Time, session, count and global windows in batch form.

The time-window functions also take streaming inputs (see ``weirflow.streaming.windows``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weirflow.functions.times import ordinal, widened
from weirflow.operators.partition import sorted_runs
from weirflow.operators.rolling import row_numbers
from weirflow.operators.running import (
    SLICE_ROWS,
    Fold,
    fold,
    null_safe,
    running,
    running_max,
    running_sum,
    slice_hot_keys,
)

MICROS = 1_000_000


def flatten_window(df: DataFrame, column: str = "window") -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != column]
    return df.select(
        F.col(f"{column}.start").alias("window_start"), F.col(f"{column}.end").alias("window_end"), *rest
    )


def time_windows(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str | None = None, **aggregates: Column
) -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) windows per key; without keys one per time span.

    Aggregation is incremental: partial results are made before the shuffle, also for hot keys
    and for windows over all keys.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(*keys, window.alias("window")).agg(*[a.alias(n) for n, a in aggregates.items()])
    return flatten_window(grouped)


def window_reduce(df: DataFrame, keys: Sequence[str], ts: str, size: str, order: Sequence[str], value: str):
    """Window reduce: the first record of the window with the sum of ``value``."""
    first = F.min(F.struct(*[ordinal(df, c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(ts)))
    out = time_windows(df, keys, ts, size, _first=first, **{f"sum_{value}": F.sum(widened(df, value))})
    return out.withColumn(f"first_{ts}", F.col(f"_first.{ts}")).drop("_first")


def window_elements(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    element: Column,
    page_rows: int = 1000,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Full-window view: key, bounds, element count, and the ordered element list in pages.

    A list holds at most ``page_rows`` elements; a larger window continues on further pages, so
    nothing is lost and no task holds a whole hot window. Null keys have windows like others.
    """
    window = F.window(ts, size)
    placed = df.withColumns({"window_start": window["start"], "window_end": window["end"], "_element": element})
    group = [*keys, "window_start", "window_end"]
    sliced = slice_hot_keys(placed, group, order, slice_rows)
    numbered = fold(sliced, [running_sum("_rn", F.lit(1).cast("bigint"))]).plain()
    paged = (
        numbered.withColumn("page", F.floor((F.col("_rn") - 1) / page_rows).cast("int"))
        .groupBy(*group, "page")
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "_element"))).alias("_list"), F.max("_rn").alias("n"))
        .withColumn("elements", F.transform("_list", lambda x: x["_element"]))
        .drop("_list")
    )
    if not sliced.slices:
        # The rows are dealt by window already: its last page knows how many there are.
        return paged.withColumn("n", F.max("n").over(Window.partitionBy(*group)))
    # The pages of a hot window stay in different tasks, and rows are counted before they are shuffled.
    counts = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return null_safe(paged.drop("n"), counts, group)


def _one_by_one(
    batches: Iterator[pd.DataFrame], group: Sequence[str], fn: Callable, rows_out: int = 10_000
) -> Iterator[pd.DataFrame]:
    """Call ``fn`` with the pieces of each group of sorted batches; give its frames out in larger ones."""

    def pieces():
        for batch in batches:
            for key, piece in batch.groupby(group, dropna=False, sort=False):
                yield tuple(None if pd.isna(part) else part for part in key), piece

    held, size = [], 0
    for _, run in groupby(pieces(), key=lambda pair: pair[0]):
        for frame in fn(piece for _, piece in run):
            held.append(frame)
            size += len(frame)
            if size >= rows_out:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _run_starts(columns: Sequence[pa.Array]) -> list[int]:
    """Where a row differs from the one before it in any of the columns (null like null, NaN like NaN); 0 included."""
    differs = np.zeros(len(columns[0]), bool)
    differs[:1] = True
    for column in columns:
        here, before = column.slice(1), column.slice(0, len(column) - 1)
        other = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(column.type):
            nan = pc.fill_null(pc.is_nan(column), False).to_numpy(zero_copy_only=False)
            other &= ~(nan[1:] & nan[:-1])
        null = column.is_null().to_numpy(zero_copy_only=False)
        differs[1:] |= other | (null[1:] != null[:-1])
    return np.flatnonzero(differs).tolist()


def _rows_one_by_one(
    batches: Iterator[pa.RecordBatch], group: Sequence[str], fn: Callable, names: Sequence[str], schema: pa.Schema, rows_out: int = 10_000
) -> Iterator[pa.RecordBatch]:
    """Call ``fn`` with slices of sorted Arrow batches for each group; give its rows out behind the group's columns."""
    place = [names.index(c) for c in group]

    def pieces():
        number, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in place]
            if last is not None:  # a group may go on in the next batch
                edges = [pa.concat_arrays([a, b.slice(0, 1)]) for a, b in zip(last, columns, strict=True)]
                number += len(_run_starts(edges)) - 1
            starts = _run_starts(columns)
            for at, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                yield number, batch, at, end
                number += 1
            number -= 1
            last = [column.slice(batch.num_rows - 1) for column in columns]

    def rows_of(first, run):
        yield first[1].slice(first[2], first[3] - first[2])
        for _, batch, at, end in run:
            yield batch.slice(at, end - at)

    held, heads, values = None, [], []

    def made() -> pa.RecordBatch:
        take = pa.array(heads, pa.int64())
        columns = [held.column(k).take(take) for k in place]
        fields = [schema.field(k) for k in range(len(place), len(schema))]
        columns += [pa.array(v, f.type) for v, f in zip(zip(*values, strict=True), fields, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    for _, run in groupby(pieces(), key=lambda piece: piece[0]):
        first = next(run)
        if heads and (first[1] is not held or len(heads) >= rows_out):
            yield made()
            heads, values = [], []
        held = first[1]
        for row in fn(rows_of(first, run)):
            heads.append(first[2])
            values.append(row)
            if len(heads) >= rows_out:
                yield made()
                heads, values = [], []
    if heads:
        yield made()


def process_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    fn: Callable[[Iterator[pd.DataFrame | pa.RecordBatch]], Iterator[pd.DataFrame | tuple]],
    schema: str,
    order: Sequence[str] = (),
    as_rows: bool = False,
) -> DataFrame:
    """Opaque logic per key and window, for what no aggregate can express.

    ``fn`` takes an iterator of pandas frames (the window's rows along ``order``, with
    ``window_start``/``window_end`` columns, in pieces no larger than an Arrow batch) and yields
    frames, so a large window passes through in bounded memory. One window of one key is still
    read by one task: prefer :func:`time_windows` or
    :func:`weirflow.operators.rolling.user_aggregate` where a key may be hot.

    A frame for each window is slow where there are many small ones. With ``as_rows`` the pieces are slices of
    Arrow batches, with columns by name, and ``fn`` yields tuples; ``schema`` has the keys,
    ``window_start``, ``window_end``, and then what is in a tuple.
    """
    window = F.window(ts, size)
    placed = df.withColumns({"window_start": window["start"], "window_end": window["end"]})
    group = [*keys, "window_start", "window_end"]
    if as_rows:
        names, made = placed.columns, to_arrow_schema(T.StructType.fromDDL(schema))
        return sorted_runs(placed, group, order).mapInArrow(lambda batches: _rows_one_by_one(batches, group, fn, names, made), schema)
    return sorted_runs(placed, group, order).mapInPandas(lambda batches: _one_by_one(batches, group, fn), schema)


def session_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    gap_seconds: Column | int,
    slice_rows: int = SLICE_ROWS,
    **aggregates: Column,
) -> DataFrame:
    """Sessions per key with a fixed gap or a gap per record (a Column of whole seconds).

    Each record covers ``[ts, ts + gap)``; records that overlap or touch share a session. A
    session starts where a record lies beyond everything its predecessors cover, so sessions are
    numbered by running folds (hot keys are sliced) and then aggregated like any group.
    ``order[0]`` is the event-time column.
    """
    ts = order[0]
    gap = gap_seconds if isinstance(gap_seconds, Column) else F.lit(gap_seconds)
    at = ordinal(df, ts)
    covered = df.withColumns(
        {"_at": at, "_until": at + gap.cast("bigint") * MICROS, "_end": F.timestamp_add("SECOND", gap, F.col(ts))}
    )
    sliced = slice_hot_keys(covered, keys, order, slice_rows)
    reached = fold(sliced, [running_max("_reach", F.col("_until"), before=True)])
    starts = F.col("_reach").isNull() | (F.col("_at") > F.col("_reach"))
    flagged = replace(reached, df=reached.df.withColumn("_new", starts.cast("bigint")))
    numbered = fold(flagged, [running_sum("session_no", F.col("_new"))]).plain()
    return numbered.groupBy(*keys, "session_no").agg(
        F.min(ts).alias("session_start"),
        F.max("_end").alias("session_end"),
        *[a.alias(n) for n, a in aggregates.items()],
    )


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int | None = None,
    slice_rows: int = SLICE_ROWS,
    **aggregates: Column,
) -> DataFrame:
    """Windows of ``size`` records per key, in order.

    Without ``slide`` they do not overlap and an incomplete last window never fires. With
    ``slide`` a window fires at every ``slide``-th record and holds the last ``size`` records or
    fewer. ``window_no`` counts firings from 1; each record is sent only to the windows it is in.
    """
    step = slide or size
    numbered = row_numbers(df, keys, order, "_rn", slice_rows)
    rn = F.col("_rn")
    first_firing = F.ceil(rn / step).cast("bigint")
    last_firing = F.floor((rn + size - 1) / step).cast("bigint")
    if slide:
        firings = F.when(first_firing <= last_firing, F.sequence(first_firing, last_firing))
        placed = numbered.withColumn("window_no", F.explode(firings))
    else:
        placed = numbered.withColumn("window_no", first_firing)
    fired = placed.groupBy(*keys, "window_no").agg(
        F.max("_rn").alias("_last"), F.count(F.lit(1)).alias("n"), *[a.alias(n) for n, a in aggregates.items()]
    )
    return fired.where(F.col("_last") == F.col("window_no") * step).drop("_last")


def global_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fire_when: Callable[[Column], Column],
    folds: Sequence[Fold],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One never-ending window per key that fires at records chosen by ``fire_when(count)``.

    Fires with everything since the key's first record; nothing fires without a trigger.
    """
    counted = running(df, keys, order, [running_sum("n", F.lit(1).cast("bigint")), *folds], slice_rows)
    return counted.where(fire_when(F.col("n")))
