"""Keyed state as tables: each micro-batch is folded by Spark's own operators and carries on from a state table.

A step takes a micro-batch and the states that earlier ones left, all DataFrames, and returns result rows and
what changes in the states. So a batch is sorted, cut at hot keys and folded in parallel inside the JVM, as
the batch operators do; no Python sees a row, and no task holds the rows of a key.

States are versioned: a micro-batch writes the rows that it changes below its own number, and overwrites them
if it is repeated, while it only reads versions of lower numbers. Every ``SNAPSHOT_EVERY``-th one first writes
the latest version of every row as a snapshot, and the versions before the last snapshot but one are deleted.
A row that is no longer needed is written with ``gone``, and left out of the next snapshot.

Results follow the order of micro-batches, and the ``order`` columns within one (rows without a value come
first): replay a bounded table with :func:`weirflow.sources.replay.ordered_stream` for one order over all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from weirflow.functions.times import ordinal, widened
from weirflow.operators import reducing
from weirflow.operators.running import SLICE_ROWS, Fold, fold, merge_top, null_safe, running_max, running_sum, running_top, slice_hot_keys
from weirflow.session import materialise
from weirflow.sources.replay import delete_folder, folder_exists
from weirflow.streaming.runs import run_folder

SNAPSHOT_EVERY = 20
GONE = "gone"

States = dict[str, DataFrame]


@dataclass(frozen=True)
class Carried:
    """``step(batch, states)`` gives ``(rows, changed states)``; ``states`` names each state's key and other columns.

    The changed rows of a state have its columns, and may have ``gone``. A state without key is a log: its changed
    rows are added, and ``prune(states)`` takes out what is no longer needed before a snapshot is written.
    """

    stream: DataFrame
    step: Callable[[DataFrame, States], tuple[DataFrame, States]]
    states: dict[str, tuple[tuple[str, ...], T.StructType]]
    prune: Callable[[States], States] = lambda states: states

    def empty(self) -> tuple[DataFrame, States]:
        spark = self.stream.sparkSession
        states = {name: spark.createDataFrame([], schema) for name, (_, schema) in self.states.items()}
        return spark.createDataFrame([], self.stream.schema), states


def _folder(folder: str, name: str, kind: str) -> str:
    return f"{folder}/state/{name}/{kind}"


def _latest(keyed: Carried, folder: str, base: int, before: int) -> States:
    """The latest row of each key below version ``before``: snapshot ``base`` (none for 0) and the changes since."""
    spark = keyed.stream.sparkSession
    out = {}
    for name, (keys, schema) in keyed.states.items():
        if not before:
            out[name] = spark.createDataFrame([], schema)
            continue
        stored = T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType())])
        versions = spark.createDataFrame([], stored).withColumn("version", F.lit(-1))
        if base:
            whole = spark.read.schema(stored).parquet(f"{_folder(folder, name, 'whole')}/version={base}")
            versions = whole.withColumn("version", F.lit(-1))
        if before > base:
            changes = _folder(folder, name, "changes")
            paths = [f"{changes}/version={k}" for k in range(base, before)]
            versions = versions.union(spark.read.schema(T.StructType([*stored.fields, T.StructField("version", T.IntegerType())])).option("basePath", changes).parquet(*paths))
        if not keys:
            out[name] = versions.select(*schema.names)
            continue
        others = [c for c in stored.names if c not in keys]
        last = versions.groupBy(*keys).agg(F.max_by(F.struct(*others), "version").alias("_last"))
        out[name] = last.select(*keys, "_last.*").where(~F.coalesce(GONE, F.lit(False))).select(*schema.names)
    return out


def states_after(keyed: Carried, folder: str, batches: int, every: int = SNAPSHOT_EVERY) -> States:
    """The states that the first ``batches`` micro-batches of the run in ``folder`` have left."""
    return keyed.prune(_latest(keyed, folder, max(0, batches - 1) // every * every, batches))


def process(keyed: Carried, batch: DataFrame, number: int, folder: str, every: int = SNAPSHOT_EVERY) -> None:
    """One micro-batch: write its rows and state changes. Repeated with the same number it writes the same again."""
    base = number // every * every
    if number and number == base:
        for name, whole in keyed.prune(_latest(keyed, folder, base - every, number)).items():
            place = _folder(folder, name, "whole")
            whole.withColumn(GONE, F.lit(False)).write.mode("overwrite").parquet(f"{place}/version={base}")
            for old in range(max(0, base - 2 * every), base - every):
                delete_folder(batch.sparkSession, f"{_folder(folder, name, 'changes')}/version={old}")
            delete_folder(batch.sparkSession, f"{place}/version={base - 2 * every}")
    rows, changed = keyed.step(batch, _latest(keyed, folder, base, number))
    rows.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={number}")
    for name, (_, schema) in keyed.states.items():
        change = changed[name]
        gone = F.col(GONE) if GONE in change.columns else F.lit(False)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        change.select(*columns, gone.alias(GONE)).write.mode("overwrite").parquet(f"{_folder(folder, name, 'changes')}/version={number}")


def start(keyed: Carried, folder: str, every: int = SNAPSHOT_EVERY, **trigger) -> StreamingQuery:
    """Run the steps; ``folder`` (shared by driver and executors) has the rows, the states and the checkpoint."""
    return (
        keyed.stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger or {"availableNow": True})
        .foreachBatch(lambda batch, number: process(keyed, batch, number, folder, every))
        .start()
    )


def written(keyed: Carried, folder: str) -> DataFrame:
    """The rows of all micro-batches so far, with ``batch_id``."""
    spark = keyed.stream.sparkSession
    if not folder_exists(spark, f"{folder}/rows"):
        return keyed.step(*keyed.empty())[0].withColumn("batch_id", F.lit(None).cast("bigint"))
    return spark.read.parquet(f"{folder}/rows").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def run_available(keyed: Carried, folder: str | None = None, every: int = SNAPSHOT_EVERY) -> DataFrame:
    """Process what is there now and return all rows; with the ``folder`` of an earlier run its states go on."""
    folder = folder or run_folder(keyed.stream.sparkSession)
    start(keyed, folder, every, availableNow=True).awaitTermination()
    return written(keyed, folder)


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as a table that is read again has it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return T.ArrayType(_nullable(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def _empty(stream: DataFrame) -> DataFrame:
    return stream.sparkSession.createDataFrame([], stream.schema)


def _of_batch(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of the keys that the micro-batch has."""
    if state.isEmpty():
        return _empty(state)
    return materialise(null_safe(state, batch.select(*keys).distinct(), keys, "left_semi", shuffled=True))


def _with_state(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the state of their key in ``_held_<column>`` (null where there is none)."""
    others = [f for f in state.schema if f.name not in keys]
    if state.isEmpty():
        return rows.withColumns({f"_held_{f.name}": F.lit(None).cast(f.dataType) for f in others})
    renamed = state.withColumnsRenamed({f.name: f"_held_{f.name}" for f in others})
    return null_safe(rows, renamed, list(keys), "left", shuffled=True)


def folded(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Callable[[DataFrame], Sequence[Fold]],
    finish: Callable[[DataFrame], DataFrame],
    slice_rows: int | None = None,
) -> Carried:
    """Any running folds: ``finish`` makes the result of rows that have a column for each fold.

    State: one row of folds per key. A batch is folded along ``order`` with hot keys cut
    (:mod:`weirflow.operators.running`) and merged with the folds that were carried in.
    """
    keys, chosen = list(keys), list(folds(_empty(stream)))

    def totals(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(*[f.aggregate().alias(f.name) for f in chosen])

    def merged(rows: DataFrame, state: DataFrame) -> DataFrame:
        both = _with_state(rows, state, keys)
        out = both.withColumns({f.name: f.merge(F.col(f"_held_{f.name}"), F.col(f.name)) for f in chosen})
        return out.drop(*[f"_held_{f.name}" for f in chosen])

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        state = _of_batch(states["folds"], batch, keys)
        cut = slice_hot_keys(batch, keys, order, **({"slice_rows": slice_rows} if slice_rows else {}))
        return finish(merged(fold(cut, chosen).plain(), state)), {"folds": merged(totals(batch), state)}

    return Carried(stream, step, {"folds": (tuple(keys), _nullable(totals(_empty(stream)).schema))})


def running_sums(stream: DataFrame, keys, order, value: str, **options) -> Carried:
    """``sum_<value>`` so far, for each record."""
    return folded(
        stream, keys, order, lambda df: [running_sum(f"sum_{value}", widened(df, value))],
        lambda out: out.select(*keys, "seq", f"sum_{value}"), **options,
    )


def running_averages(stream: DataFrame, keys, order, value: str, **options) -> Carried:
    """``avg_<value>`` of the values so far that are not null."""

    def folds(df: DataFrame) -> list[Fold]:
        return [running_sum("_sum", widened(df, value)), running_sum("_n", F.col(value).isNotNull().cast("bigint"))]

    average = F.col("_sum") / F.when(F.col("_n") > 0, F.col("_n"))
    return folded(stream, keys, order, folds, lambda out: out.select(*keys, "seq", average.alias(f"avg_{value}")), **options)


def reduced(stream: DataFrame, keys, order, folds: Callable[[DataFrame], Sequence[Fold]], **options) -> Carried:
    """Running reduce: the folded columns over the record's own ones."""
    return folded(stream, keys, order, folds, lambda out: out, **options)


def record_counters(stream: DataFrame, keys, order, **options) -> Carried:
    """Number of the key's earlier records: 0, 1, 2, ..., also across restarts."""
    return folded(
        stream, keys, order, lambda df: [running_sum("counter", F.lit(1).cast("bigint"))],
        lambda out: out.select(*keys, "seq", (F.col("counter") - 1).alias("counter")), **options,
    )


def jumps(stream: DataFrame, keys, order, value: str, limit: int, **options) -> Carried:
    """Records that differ from the key's last one by more than ``limit`` (the first is compared with 0).

    A null value is not compared, and is the last one of no record.
    """

    def folds(df: DataFrame) -> list[Fold]:
        # The number in the order of micro-batches is the batch's own: a later batch's records are always later.
        at = [F.coalesce(ordinal(df, c), F.lit(-(1 << 63))).alias(f"_o{i}") for i, c in enumerate(order)]
        last = F.struct(F.col("_batch"), *at, F.col(value).alias("_v"))
        return [running_max("_prev", F.when(F.col(value).isNotNull(), last), before=True)]

    previous = F.coalesce(F.col("_prev._v"), F.lit(0).cast(stream.schema[value].dataType))
    far = F.abs(F.col(value) - previous) > limit

    def finish(out: DataFrame) -> DataFrame:
        return out.where(far).select(*keys, "seq", value, previous.alias(f"prev_{value}"))

    return _numbered(stream, keys, order, folds, finish, **options)


def _numbered(stream: DataFrame, keys, order, folds, finish, **options) -> Carried:
    """:func:`folded` over rows with ``_batch``, the number of their micro-batch, carried as a state of its own."""
    numbered = stream.withColumn("_batch", F.lit(0).cast("bigint"))
    inner = folded(numbered, keys, order, folds, finish, **options)
    clock = T.StructType([T.StructField("one", T.IntegerType()), T.StructField("batch", T.LongType())])

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        row = states["clock"].first()
        now = row["batch"] + 1 if row else 0
        rows, changed = inner.step(batch.withColumn("_batch", F.lit(now).cast("bigint")), states)
        return rows, changed | {"clock": batch.sparkSession.createDataFrame([(0, now)], clock)}

    return Carried(stream, step, inner.states | {"clock": (("one",), clock)})


def value_counts_so_far(stream: DataFrame, keys, order, value: str, **options) -> Carried:
    """The entry of the key's value-to-count map that each record changes, after the change."""
    return folded(
        stream, [*keys, value], order, lambda df: [running_sum("n", F.lit(1).cast("bigint"))],
        lambda out: out.select(*keys, "seq", value, "n"), **options,
    )


def global_window(stream: DataFrame, keys, order, value: str, fire_when: Callable[[Column], Column], **options) -> Carried:
    """One endless window per key, with its count and sum where ``fire_when(count)``."""

    def folds(df: DataFrame) -> list[Fold]:
        return [running_sum("n", F.lit(1).cast("bigint")), running_sum(f"sum_{value}", widened(df, value))]

    return folded(stream, keys, order, folds, lambda out: out.where(fire_when(F.col("n"))).select(*keys, "seq", "n", f"sum_{value}"), **options)


def top_so_far(stream: DataFrame, keys, order, value: str, k: int = 3, slice_rows: int | None = None) -> Carried:
    """The ``k`` largest values so far, for each record. State: that list for each key."""
    keys = list(keys)
    kind = T.ArrayType(stream.schema[value].dataType)
    schema = T.StructType([*(stream.schema[c] for c in keys), T.StructField("top", kind)])

    def merged(rows: DataFrame, state: DataFrame) -> DataFrame:
        both = _with_state(rows, state, keys)
        held = F.when(F.col("_held_top").isNull(), F.col("top")).otherwise(merge_top(k, [F.col("_held_top"), F.col("top")]))
        return both.withColumn("top", held).drop("_held_top")

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        state = _of_batch(states["top"], batch, keys)
        local = running_top(batch, keys, order, value, k, "top", **({"slice_rows": slice_rows} if slice_rows else {}))
        # Ranks above k leave in the tasks before the shuffle.
        ranked = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(value))
        best = batch.select(*keys, value).withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k)
        ends = best.groupBy(*keys).agg(F.sort_array(F.collect_list(value), asc=False).alias("top"))
        return merged(local, state).select(*keys, "seq", "top"), {"top": merged(ends, state)}

    return Carried(stream, step, {"top": (tuple(keys), schema)})


def count_windows(
    stream: DataFrame, keys, order, value: str, size: int, slide: int | None = None, slice_rows: int | None = None
) -> Carried:
    """``(window_no, n, elements)`` at every ``slide``-th record of a key, with its last ``size`` records or fewer.

    State: the number of records of each key, and those of the last ``size`` that a later window needs.
    """
    keys, step_by = list(keys), slide or size
    place = T.StructType([T.StructField("rn", T.LongType()), stream.schema[value]])
    schema = T.StructType([*(stream.schema[c] for c in keys), T.StructField("seen", T.LongType()), T.StructField("recent", T.ArrayType(place))])
    rn = F.col("rn")

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        state = _of_batch(states["recent"], batch, keys)
        cut = slice_hot_keys(batch, keys, order, **({"slice_rows": slice_rows} if slice_rows else {}))
        local = fold(cut, [running_sum("rn", F.lit(1).cast("bigint"))]).plain()
        before = F.coalesce("_held_seen", F.lit(0))
        numbered = _with_state(local, state, keys).select(*keys, (rn + before).alias("rn"), value, before.alias("_before"))
        recent = state.select(*keys, F.explode("recent").alias("_r"), F.col("seen").alias("_before")).select(*keys, "_r.*", "_before")
        # Written once: windows and what is left are both made of it.
        every = materialise(numbered.unionByName(recent))
        counted = _with_state(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen")), state, keys)
        seen = materialise(counted.select(*keys, (F.col("seen") + F.coalesce("_held_seen", F.lit(0))).alias("seen")))
        first, last = F.ceil(rn / step_by).cast("bigint"), F.floor((rn + size - 1) / step_by).cast("bigint")
        # Windows that have not fired yet.
        unfired = F.greatest(first, F.floor(F.col("_before") / step_by).cast("bigint") + 1)
        placed = every.withColumn("window_no", F.explode(F.when(unfired <= last, F.sequence(unfired, last))))
        fired = placed.groupBy(*keys, "window_no").agg(
            F.max("rn").alias("_last"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("rn", value))).alias("_list")
        )
        rows = fired.where(F.col("_last") == F.col("window_no") * step_by).select(
            *keys, "window_no", "n", F.transform("_list", lambda x: x[value]).alias("elements")
        )
        # Of the records only those that the next window, or a later one, still has.
        needed = null_safe(every, seen, keys, shuffled=True).where(last > F.floor(F.col("seen") / step_by))
        left = needed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rn", value))).alias("recent"))
        kept = null_safe(seen, left, keys, "left", shuffled=True)
        return rows, {"recent": kept.withColumn("recent", F.coalesce("recent", F.array().cast(schema["recent"].dataType)))}

    return Carried(stream, step, {"recent": (tuple(keys), schema)})


def reduced_by(
    stream: DataFrame, keys, order, values: Sequence[str], combine: Callable[[tuple, tuple], tuple], slice_rows: int = SLICE_ROWS
) -> Carried:
    """Running reduce with any associative function of two tuples (:mod:`weirflow.operators.reducing`).

    ``reduced_<value>`` is added to each record. State: for each key what its records have come to.
    """
    keys, values = list(keys), list(values)
    schema = T.StructType([*(stream.schema[c] for c in keys), *(stream.schema[v] for v in values)])

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        state = _of_batch(states["held"], batch, keys)
        rows = reducing.running_reduce(batch, keys, order, values, combine, initial=state, slice_rows=slice_rows)
        # The state goes before the batch's own result, as an earlier part.
        own = reducing.reduce_groups(batch, keys, order, values, combine, slice_rows)
        parts = state.withColumn("_part", F.lit(0)).unionByName(own.withColumn("_part", F.lit(1)))
        return rows, {"held": reducing.reduce_groups(parts, keys, ["_part"], values, combine, slice_rows)}

    return Carried(stream, step, {"held": (tuple(keys), _nullable(schema))})
