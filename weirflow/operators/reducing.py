"""Reduce with any associative function of two records, along an order, also where a key is hot.

What Spark's aggregates can't express (concatenation, matrix products, automata) is a Python function of two
tuples here. Rows stream through a task in sorted runs, so no group is ever held. A hot key is cut into slices
(:mod:`weirflow.operators.running`) and scanned in three steps: each slice is reduced on its own, the
results of the slices, one row each, are scanned along their order, and every slice then runs again from what
the slices before it came to. The function need not be commutative, but it must be associative.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.partition import sorted_runs
from weirflow.operators.running import SLICE_ROWS, null_safe, slice_hot_keys
from weirflow.session import materialise

Combine = Callable[[tuple, tuple], tuple]


def _carry(values: Sequence[str]) -> list[str]:
    return ["_has_carry", *(f"_carry_{v}" for v in values)]


def _tuples(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple]:
    if not names:
        return iter([()] * batch.num_rows)
    return zip(*(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names), strict=True)


def _results(of: list[tuple], kinds: Sequence[pa.DataType]) -> list[pa.Array]:
    columns = zip(*of, strict=True) if of else [[] for _ in kinds]
    return [pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=True)]


def _scanned(rows: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str], combine: Combine, prefix: str) -> DataFrame:
    """``rows`` with ``<prefix><value>``: what the group's rows up to this one reduce to, on top of its carry if it has one."""
    added = [T.StructField(f"{prefix}{v}", rows.schema[v].dataType) for v in values]
    carried = _carry(values) if "_has_carry" in rows.columns else []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            found = []
            carries = _tuples(batch, carried)
            for key, row, carry in zip(_tuples(batch, group), _tuples(batch, values), carries, strict=True):
                if key != last or held is None:
                    last, held = key, combine(carry[1:], row) if carry and carry[0] else row
                else:
                    held = combine(held, row)
                found.append(held)
            kinds = [batch.schema.field(v).type for v in values]
            columns = [*batch.columns, *_results(found, kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(f.name for f in added)])

    return sorted_runs(rows, group, order).mapInArrow(scan, T.StructType([*rows.schema.fields, *added]))


def _reduced(rows: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str], combine: Combine) -> DataFrame:
    """One row for each group: its columns and what its rows reduce to along ``order``."""
    schema = T.StructType([*(rows.schema[c] for c in group), *(T.StructField(v, rows.schema[v].dataType) for v in values)])
    columns = [*group, *values]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, kinds = None, None, None
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in columns]
            done = []
            for key, row in zip(_tuples(batch, group), _tuples(batch, values), strict=True):
                if held is not None and key == last:
                    held = combine(held, row)
                    continue
                if held is not None:
                    done.append((*last, *held))
                last, held = key, row
            if done:
                yield pa.RecordBatch.from_arrays(_results(done, kinds), columns)
        if held is not None:
            yield pa.RecordBatch.from_arrays(_results([(*last, *held)], kinds), columns)

    return sorted_runs(rows.select(*dict.fromkeys([*group, *order, *values])), group, order).mapInArrow(reduce, schema)


def reduce_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], combine: Combine, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The ``values`` of each key's records reduced along ``order``: one row for each key, null keys included.

    ``combine(a, b)`` gets the values of an earlier and a later part as tuples, nulls as ``None``, and gives a tuple of
    the same types; a single record is its own result. An empty table has no rows.
    """
    sliced = slice_hot_keys(df.select(*dict.fromkeys([*keys, *order, *values])), keys, order, slice_rows)
    slices = _reduced(sliced.df, sliced.group, order, values, combine)
    return _reduced(slices, list(keys), sliced.slices, values, combine) if sliced.slices else slices


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    combine: Combine,
    prefix: str = "reduced_",
    initial: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` with ``<prefix><value>``: the reduction of the key's records up to and including each one.

    ``initial`` (keys and ``values``) has what some keys start from, such as the results of an earlier part.
    """
    sliced = slice_hot_keys(df, keys, order, slice_rows)
    if initial is not None:
        initial = initial.select(*keys, F.lit(True).alias("_has_carry"), *[F.col(v).alias(f"_carry_{v}") for v in values])
    if not sliced.slices:
        rows = sliced.df if initial is None else null_safe(sliced.df, initial, list(keys), "left", shuffled=True)
        return _scanned(rows, list(keys), order, values, combine, prefix).drop(*_carry(values))
    # What the slices of each key come to, and from that what each of them starts with.
    totals = materialise(_reduced(sliced.hot(), sliced.group, order, values, combine))
    if initial is not None:
        totals = null_safe(totals, initial, list(keys), "left", shuffled=True)
    up_to = _scanned(totals, list(keys), sliced.slices, values, combine, "_up_to_").drop(*_carry(values))
    starts = _shifted(up_to, list(keys), sliced.slices, values)
    if initial is not None:
        whole = {c: F.lit(0) for c in sliced.slices}
        first = null_safe(up_to.groupBy(*keys).agg(F.min(F.struct(*sliced.slices)).alias("_s")).select(*keys, "_s.*"), initial, list(keys), shuffled=True)
        starts = starts.unionByName(first).unionByName(initial.withColumns(whole))
    rows = null_safe(sliced.df, materialise(starts), sliced.group, "left", shuffled=initial is not None)
    return _scanned(rows, sliced.group, order, values, combine, prefix).drop(*_carry(values), *sliced.slices)


def _shifted(up_to: DataFrame, keys: list[str], slices: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For each slice but a key's first: what the slices before it come to."""
    along = Window.partitionBy(*keys).orderBy(*slices)
    held = F.lag(F.struct(*[f"_up_to_{v}" for v in values])).over(along)
    moved = up_to.select(*keys, *slices, held.alias("_held")).where("_held is not null")
    return moved.select(*keys, *slices, F.lit(True).alias("_has_carry"), *[F.col(f"_held._up_to_{v}").alias(f"_carry_{v}") for v in values])


def window_reduce(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    values: Sequence[str],
    combine: Combine,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """:func:`reduce_groups` in tumbling windows: keys, ``window_start``, ``window_end`` and the reduced values."""
    window = F.window(ts, size)
    placed = df.withColumns({"window_start": window["start"], "window_end": window["end"]})
    return reduce_groups(placed, [*keys, "window_start", "window_end"], order, values, combine, slice_rows)
