"""Rolling (per record) and grouped aggregation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.times import ordinal, widened
from weirflow.operators.partition import sorted_runs
from weirflow.operators.running import SLICE_ROWS, Fold, running, running_max, running_min, running_sum


def _first_record(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> Column:
    return F.struct(*[ordinal(df, c).alias(f"_o{i}") for i, c in enumerate(order)], *columns)


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    first_of: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Running sum per key as ``sum_<value>``; columns in ``first_of`` keep the key's first record."""
    folds = [running_sum(f"sum_{value}", widened(df, value))]
    if first_of:
        folds.append(running_min("_first", _first_record(df, order, first_of)))
    out = running(df, keys, order, folds, slice_rows)
    return out.withColumns({f"first_{c}": F.col(f"_first.{c}") for c in first_of}).drop("_first")


def rolling_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: Sequence[Fold], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Running reduce: the folded columns over the record's own (latest) columns."""
    return running(df, keys, order, folds, slice_rows)


def rolling_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    first_of: Sequence[str],
    largest: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Running max/min of one field (``best_<value>``); other fields keep the first record's values."""
    make = running_max if largest else running_min
    folds = [
        make(f"best_{value}", F.col(value)),
        running_min("_first", _first_record(df, order, first_of)),
    ]
    out = running(df, keys, order, folds, slice_rows)
    return out.withColumns({f"first_{c}": F.col(f"_first.{c}") for c in first_of}).drop("_first")


def rolling_extreme_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    record: Sequence[str],
    largest: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Running maxBy/minBy: the whole record that holds the extreme; the earliest wins a tie.

    A null value is no extreme: its record is never the best.
    """
    age = [ordinal(df, c) for c in order]
    ranked = F.struct(
        F.col(value).alias("_v"), *[(-a if largest else a).alias(f"_o{i}") for i, a in enumerate(age)], *record
    )
    make = running_max if largest else running_min
    out = running(df, keys, order, [make("_best", F.when(F.col(value).isNotNull(), ranked))], slice_rows)
    return out.withColumns({f"best_{c}": F.col(f"_best.{c}") for c in record}).drop("_best")


def rolling_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Running average per key over the values that are not null, from a sum and a count."""
    counted = F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("bigint")
    folds = [running_sum("_sum", widened(df, value)), running_sum("_n", counted)]
    out = running(df, keys, order, folds, slice_rows)
    return out.withColumn(f"avg_{value}", F.col("_sum") / F.when(F.col("_n") > 0, F.col("_n"))).drop("_sum", "_n")


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """1-based position of each record within its key."""
    return running(df, keys, order, [running_sum(name, F.lit(1).cast("bigint"))], slice_rows)


def grouped(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Final value per key; Catalyst aggregates partially before the shuffle."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def _exact_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keys without nulls, and a flag for each: pandas would turn whole numbers beside a null into floats."""

    def default(kind: T.DataType) -> Column:
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit("1970-01-01").cast(kind)
        return F.lit("").cast(kind) if isinstance(kind, T.StringType) else F.lit(0).cast(kind)

    flags = {f"_null_{k}": F.col(k).isNull() for k in keys}
    filled = {k: F.coalesce(k, default(df.schema[k].dataType)) for k in keys}
    return df.withColumns(flags).withColumns(filled), [*keys, *flags]


def _as_asked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    restored = df.withColumns({k: F.when(~F.col(f"_null_{k}"), F.col(k)) for k in keys})
    return restored.drop(*[f"_null_{k}" for k in keys])


def user_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    add: Callable[[DataFrameGroupBy], pd.DataFrame],
    merge: Callable[[DataFrameGroupBy], pd.DataFrame],
    result: Callable[[pd.DataFrame], pd.DataFrame],
    accumulator: str,
    output: str,
    flush_rows: int = 100_000,
) -> DataFrame:
    """Aggregate with a user-defined accumulator (input, accumulator and output types may differ).

    ``add`` folds grouped input rows to one accumulator per key, ``merge`` folds grouped
    accumulators likewise, and ``result`` turns accumulators into output columns; all three work
    on whole pandas frames. Accumulators are combined inside each input task before the shuffle,
    so a hot key sends a few per task, and after it they are merged along the sorted keys.
    ``accumulator`` and ``output`` are DDL column lists without the keys.
    """
    asked, df, keys = list(keys), *_exact_keys(df, keys)
    key_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def fold(rows: pd.DataFrame, how) -> pd.DataFrame:
        return how(rows.groupby(keys, dropna=False, sort=False)).reset_index()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not batch.empty:
                held.append(fold(batch, add))
            if sum(map(len, held)) > flush_rows:
                yield fold(pd.concat(held, ignore_index=True), merge)
                held = []
        if held:
            yield fold(pd.concat(held, ignore_index=True), merge)

    def finish(accumulators: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([accumulators[keys], result(accumulators)], axis=1)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            if batch.empty:
                continue
            merged = fold(batch if last is None else pd.concat([last, batch], ignore_index=True), merge)
            # The last key may go on in the next batch.
            last = merged.iloc[-1:].reset_index(drop=True)
            yield finish(merged.iloc[:-1])
        if last is not None:
            yield finish(last)

    partials = df.mapInPandas(partial, f"{key_ddl}, {accumulator}")
    combined = sorted_runs(partials, keys).mapInPandas(combine, f"{key_ddl}, {output}")
    return _as_asked(combined, asked)
