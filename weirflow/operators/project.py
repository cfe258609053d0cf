"""Maps, filters and flat-maps (batch and streaming)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.scalars import words


def map_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """One output row per input row, made of the named expressions."""
    return df.select(*[expr.alias(name) for name, expr in columns.items()])


def keep(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def flat_map(df: DataFrame, values: Column, name: str, carry: list[str] | None = None) -> DataFrame:
    """One output row per element of the array expression ``values`` (none for an empty array)."""
    return df.select(*(carry or []), F.explode(values).alias(name))


def branches(*cases: tuple[Column, list[Column]]) -> Column:
    """Array expression for a conditional flat-map: the first case that holds gives the elements."""
    chain = None
    for condition, elements in cases:
        as_text = F.array(*[e.cast("string") for e in elements])
        chain = F.when(condition, as_text) if chain is None else chain.when(condition, as_text)
    return chain.otherwise(F.array().cast("array<string>"))


def split_lines(df: DataFrame, text: str) -> DataFrame:
    """Whole texts to one row per line."""
    return df.select(F.explode(F.split(F.col(text), "\n")).alias("value"))


def tokenise(df: DataFrame, line: str = "value", carry: list[str] | None = None) -> DataFrame:
    return flat_map(df, words(F.col(line)), "word", carry)


def word_count(lines: DataFrame) -> DataFrame:
    """Count of each word over lines; partial counts are made before the shuffle."""
    return tokenise(lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def flat_map_with(df: DataFrame, fn: Callable[[dict], list[tuple]], schema: str) -> DataFrame:
    """Opaque one-to-many map: ``fn`` gives the output rows of one input row, batch by batch in Arrow.

    Values reach ``fn`` as Python values, so whole numbers beside nulls stay whole.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in fn(row)]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(task, kind)


def map_with_lifecycle(
    df: DataFrame,
    open_task: Callable[[int], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    close_task: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """Map Arrow batches with a resource opened and closed once per task.

    ``open_task`` gets the partition number and returns the resource; ``close_task`` runs also
    when the task fails. For plain arithmetic use a column expression instead.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_task(TaskContext.get().partitionId())
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close_task(resource)

    return df.mapInPandas(task, schema)
