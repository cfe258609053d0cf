"""Running folds per key (one output row per input row) that survive hot keys.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task. So hot keys are looked
for first. If no key has more than ``slice_rows`` rows the plain window is used. Otherwise the hot
keys are cut into consecutive slices of their own order, each slice is folded in its own task, and
the folds of the earlier slices are carried in from a table with one row per slice. The other keys
stay whole.

The search counts a sample of the key columns, so it shuffles almost nothing; only the keys that
stand out are then counted exactly. The sample decides where the work is cut, never which rows are
in the result: every row is folded either way.

Bounds: at most ``rows / slice_rows`` keys can be hot, and cuts lie at quantiles, so the tables of hot
keys and of carried folds are smaller than the data by about that factor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.times import ordinal
from weirflow.session import broadcast_if_small, materialise

SLICE_ROWS = 2_000_000
# Into so many parts at most a slice is cut at once.
PARTS = 64
# A key at the limit shows up this often in the sample; it stands out from half of that.
SAMPLED_PER_LIMIT = 100


@dataclass(frozen=True)
class Fold:
    """One running fold; ``before`` leaves the current row out of the frame."""

    name: str
    kind: str
    expr: Column
    before: bool = False

    def aggregate(self) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.expr)

    def merge(self, earlier: Column, local: Column) -> Column:
        if self.kind == "sum":
            both = earlier + local
            return F.coalesce(both, local, earlier)
        return (F.least if self.kind == "min" else F.greatest)(earlier, local)


def running_sum(name: str, expr: Column, before: bool = False) -> Fold:
    return Fold(name, "sum", expr, before)


def running_min(name: str, expr: Column, before: bool = False) -> Fold:
    return Fold(name, "min", expr, before)


def running_max(name: str, expr: Column, before: bool = False) -> Fold:
    return Fold(name, "max", expr, before)


@dataclass(frozen=True)
class Sliced:
    """Rows with zero or more slice columns that, with the keys, bound the size of a group."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    slices: tuple[str, ...] = ()

    @property
    def group(self) -> list[str]:
        return [*self.keys, *self.slices]

    def frame(self, end: int):
        ordered = Window.partitionBy(*self.group).orderBy(*self.order)
        return ordered.rowsBetween(Window.unboundedPreceding, end)

    def hot(self) -> DataFrame:
        return self.df.where(F.col(self.slices[0]) > 0)

    def plain(self) -> DataFrame:
        return self.df.drop(*self.slices)


def _standing_out(df: DataFrame, keys: Sequence[str], slice_rows: int) -> DataFrame:
    """Keys that may have more than ``slice_rows`` rows (few others among them)."""
    fraction = min(1.0, SAMPLED_PER_LIMIT / slice_rows)
    counts = df.select(*keys).sample(fraction, seed=1).groupBy(*keys).agg(F.count(F.lit(1)).alias("_sampled"))
    return counts.where(F.col("_sampled") > slice_rows * fraction / 2).drop("_sampled")


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", shuffled: bool = False) -> DataFrame:
    """Equi join in which a null key meets a null key; the right side's keys are dropped.

    ``shuffled`` keeps the right side among the executors: for tables that each micro-batch of a stream joins anew,
    of which even small ones would come to much in the driver.
    """
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    placed = renamed.hint("merge") if shuffled else broadcast_if_small(renamed)
    return left.join(placed, same, how).drop(*[f"_on_{c}" for c in on])


def _cuts(rows: DataFrame, group: Sequence[str], places: Sequence[Column], slice_rows: int) -> DataFrame:
    """Per group with more than ``slice_rows`` rows: which order column to cut along, and where.

    That is the first one that has more than one value left in the group; the cuts are quantiles.
    """
    steps = F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)])
    measured = []
    for i, place in enumerate(places):
        varies = (F.min(place) < F.max(place)) | (F.count(place).between(1, F.count(F.lit(1)) - 1))
        measured += [varies.alias(f"_varies{i}"), F.percentile_approx(place, steps, 10_000).alias(f"_at{i}")]
    sized = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *measured).where(F.col("_n") > slice_rows)
    along, bounds = F.lit(None).cast("int"), F.lit(None).cast("array<bigint>")
    for i in reversed(range(len(places))):
        chosen = F.coalesce(f"_varies{i}", F.lit(False))
        along, bounds = F.when(chosen, i).otherwise(along), F.when(chosen, F.col(f"_at{i}")).otherwise(bounds)
    # Only as many parts as the group needs: half full on average.
    needed = F.least(F.lit(PARTS), F.ceil(2 * F.col("_n") / slice_rows))
    stride = F.greatest(F.lit(1), F.floor(F.lit(PARTS) / needed)).cast("int")
    thinned = F.filter(bounds, lambda _, k: (k + 1) % stride == 0)
    cut = sized.select(*group, along.alias("_along"), F.array_distinct(thinned).alias("_bounds"))
    return cut.where("_along is not null")


def slice_hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS) -> Sliced:
    """Cut keys with more than ``slice_rows`` rows into slices numbered along ``order``.

    A slice column is 0 for rows that are not cut. Each level cuts the slices that are still too large at
    quantiles of the first order column that varies in them, until none is too large: only rows that are
    equal in the whole order stay together. Null keys are cut like others.
    """
    places = [ordinal(df, c) for c in order]
    out = Sliced(df, tuple(keys), tuple(order))
    suspects = materialise(_standing_out(df, keys, slice_rows))
    if suspects.isEmpty():
        return out
    rows = null_safe(df, suspects, list(keys))
    while True:
        # Few groups from here on, so counting them shuffles only partial counts.
        cuts = materialise(_cuts(rows, out.group, places, slice_rows))
        if cuts.isEmpty():
            return out
        position = F.lit(None).cast("bigint")
        for i, place in enumerate(places):
            position = F.when(F.col("_along") == i, place).otherwise(position)
        # A value that is a bound itself gets a number of its own; nulls come first.
        below = F.size(F.filter("_bounds", lambda b: b < position)) + F.size(F.filter("_bounds", lambda b: b <= position))
        number = F.when(F.col("_along").isNull(), 0).when(position.isNull(), 1).otherwise(below + 2).cast("bigint")
        name = f"_slice{len(out.slices)}"
        cut = null_safe(out.df, cuts, out.group, "left").withColumn(name, number)
        out = Sliced(cut.drop("_along", "_bounds"), out.keys, out.order, (*out.slices, name))
        rows = out.hot()


def fold(sliced: Sliced, folds: Sequence[Fold]) -> Sliced:
    """Add one running column per fold."""
    up_to_now, up_to_last = sliced.frame(Window.currentRow), sliced.frame(-1)
    local = sliced.df.withColumns(
        {f.name: f.aggregate().over(up_to_last if f.before else up_to_now) for f in folds}
    )
    if not sliced.slices:
        return replace(sliced, df=local)
    totals = sliced.hot().groupBy(*sliced.group).agg(*[f.aggregate().alias(f"_total_{f.name}") for f in folds])
    earlier = (
        Window.partitionBy(*sliced.keys).orderBy(*sliced.slices).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *sliced.group,
        *[
            replace(f, expr=F.col(f"_total_{f.name}")).aggregate().over(earlier).alias(f"_carry_{f.name}")
            for f in folds
        ],
    )
    joined = null_safe(local, carried, sliced.group, "left")
    merged = joined.withColumns({f.name: f.merge(F.col(f"_carry_{f.name}"), F.col(f.name)) for f in folds})
    return replace(sliced, df=merged.drop(*[f"_carry_{f.name}" for f in folds]))


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: Sequence[Fold], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``df`` with one column per fold, folded per key along ``order`` (must be total)."""
    return fold(slice_hot_keys(df, keys, order, slice_rows), folds).plain()


def merge_top(k: int, arrays: Sequence[Column]) -> Column:
    """The ``k`` largest values of several short arrays, largest first."""
    return F.slice(F.sort_array(reduce(F.concat, arrays), asc=False), 1, k)


def _top_ladder(df: DataFrame, value: Column, k: int, ordered) -> tuple[DataFrame, list[str]]:
    """Columns holding the running 1st..k-th largest value, by k chained running maxima.

    The value a rung does not keep (the smaller of the newcomer and the rung's old value) falls
    to the rung below, so each rung is one streaming window frame and no array ever grows.
    """
    up_to_now = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up_to_last = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rungs = []
    out = df.withColumn("_falling", value)
    for rung in range(k):
        name, old = f"_top{rung}", f"_old{rung}"
        out = out.withColumn(name, F.max("_falling").over(up_to_now)).withColumn(
            old, F.max("_falling").over(up_to_last)
        )
        # least() skips nulls, but an empty rung lets nothing fall.
        fallen = F.when(F.col(old).isNotNull() & F.col("_falling").isNotNull(), F.least("_falling", old))
        out = out.withColumn("_falling", fallen).drop(old)
        rungs.append(name)
    return out.drop("_falling"), rungs


def _as_array(columns: Sequence[str]) -> Column:
    return F.filter(F.array(*columns), lambda x: x.isNotNull())


def running_top(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    k: int,
    name: str = "top",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` with the ``k`` largest values seen so far per key (largest first, duplicates kept)."""
    sliced = slice_hot_keys(df, keys, order, slice_rows)
    local, rungs = _top_ladder(sliced.df, F.col(value), k, Window.partitionBy(*sliced.group).orderBy(*order))
    local = local.withColumn(name, _as_array(rungs)).drop(*rungs)
    if not sliced.slices:
        return local

    best = Window.partitionBy(*sliced.group).orderBy(F.col(value).desc_nulls_last(), *order)
    kept = (
        sliced.hot()
        .select(*sliced.group, *order, value)
        .withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= k)
    )
    # At most k rows per slice from here on.
    along = Window.partitionBy(*keys).orderBy(*sliced.slices, "_rank")
    ladder, rungs = _top_ladder(kept, F.col(value), k, along)
    ends = ladder.withColumn("_size", F.max("_rank").over(Window.partitionBy(*sliced.group))).where(
        F.col("_rank") == F.col("_size")
    )
    by_slice = Window.partitionBy(*keys).orderBy(*sliced.slices)
    carried = ends.select(*sliced.group, F.lag(_as_array(rungs)).over(by_slice).alias("_carry"))
    both = merge_top(k, [F.col("_carry"), F.col(name)])
    out = null_safe(local, carried, sliced.group, "left").withColumn(
        name, F.when(F.col("_carry").isNull(), F.col(name)).otherwise(both)
    )
    return out.drop("_carry", *sliced.slices)
