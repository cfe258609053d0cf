"""Late data on streams with a bounded delay: watermarks between arrivals, revisions, and late outputs.

The watermark trails the largest event time by a delay that may be far smaller than the disorder of the
input; what is later than that is told apart, never lost. Arrivals are the values of a column (such as the hour in
which a record came in), several of which may share a micro-batch, or the micro-batches themselves. A record sees
the watermark that all earlier arrivals have left, and it never goes back.

All functions are steps over state tables (:mod:`weirflow.streaming.carried`). Results do not depend on
how arrivals are dealt to micro-batches as long as each is in one of them, in their order:
:func:`weirflow.sources.replay.ordered_stream` by the arrival column does that for a table. Times are
epoch milliseconds, as in :mod:`weirflow.operators.eventtime`, whose results these are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import eventtime
from weirflow.operators.joins import interval_join
from weirflow.operators.running import Fold, null_safe, running_sum
from weirflow.session import materialise
from weirflow.streaming.carried import GONE, Carried, States, _empty, _nullable, _with_state

CLOCK = T.StructType(
    [T.StructField("one", T.IntegerType()), T.StructField("arrival", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("left_ms", "right_ms"))]
)
LEFT, RIGHT = "left", "right"


def _arrived(batch: DataFrame, states: States, arrival: str | None, ts_ms: str, delay_ms: int, side: str | None):
    """The rows with ``_arrival``, its watermarks (``wm_in``, ``wm_out``; null: none yet), and the clock after it."""
    held = states["clock"].first() or {"arrival": -1, "left_ms": None, "right_ms": None}
    number = F.lit(held["arrival"] + 1) if arrival is None else F.col(arrival)
    rows = batch.withColumn("_arrival", number.cast("bigint"))
    of = [F.lit(True), F.lit(True)] if side is None else [F.col(side) == LEFT, F.col(side) == RIGHT]
    names = ["left_ms", "right_ms"]
    per_arrival = rows.groupBy("_arrival").agg(*[F.max(F.when(mine, F.col(ts_ms))).alias(n) for mine, n in zip(of, names, strict=True)])
    along = Window.orderBy("_arrival")  # One row for each arrival of a micro-batch.

    def mark(frame) -> F.Column:
        seen = [F.greatest(F.lit(held[n]).cast("bigint"), F.max(n).over(frame)) for n in names]
        return F.when(seen[0].isNotNull() & seen[1].isNotNull(), F.least(*seen) - delay_ms - 1)

    before, up_to = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(Window.unboundedPreceding, 0)
    trace = materialise(per_arrival.withColumns({"wm_in": mark(before), "wm_out": mark(up_to)}))
    last = trace.agg(*[F.max(c).alias(c) for c in ("_arrival", *names)]).first()

    def latest(name: str, new: int | None) -> int | None:
        return max((x for x in (held[name], new) if x is not None), default=None)

    clock = (0, latest("arrival", last["_arrival"]), latest("left_ms", last["left_ms"]), latest("right_ms", last["right_ms"]))
    return rows, trace, clock


def _clock_table(df: DataFrame, clock: tuple) -> DataFrame:
    return df.sparkSession.createDataFrame([clock], CLOCK)


def _watermark(clock, delay_ms: int) -> int | None:
    """The watermark of a clock row."""
    if clock is None or clock[2] is None or clock[3] is None:
        return None
    return min(clock[2], clock[3]) - delay_ms - 1


def late_split(stream: DataFrame, ts_ms: str, delay_ms: int, size_ms: int, lateness_ms: int = 0, arrival: str | None = None) -> Carried:
    """Each row with ``window_end_ms``, the watermark ``wm_in`` it sees, and its ``status`` (on time, refired, dropped).

    State: the clock, one row.
    """

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        rows, trace, clock = _arrived(batch, states, arrival, ts_ms, delay_ms, None)
        tagged = eventtime.late_split(rows, trace, "_arrival", ts_ms, size_ms, lateness_ms)
        return tagged.drop("_arrival"), {"clock": _clock_table(batch, clock)}

    return Carried(stream, step, {"clock": (("one",), CLOCK)})


def allowed_lateness(
    stream: DataFrame,
    keys: Sequence[str],
    ts_ms: str,
    delay_ms: int,
    size_ms: int,
    lateness_ms: int,
    folds: Callable[[DataFrame], Sequence[Fold]],
    arrival: str | None = None,
) -> Carried:
    """Results of tumbling windows with revisions: ``window_end_ms, firing_batch, revision, n`` and the folds.

    A window fires after the arrival that brings the watermark to its end, and again for each later arrival
    with rows for it, until ``lateness_ms`` after that; rows later still are :func:`late_split`'s to report. Rows are
    added up by their folds before anything is joined. State: the folds of windows that may still fire or change,
    deleted as the watermark passes; :func:`close_windows` fires those that are open when the input ends.
    """
    keys, place = list(keys), [*keys, "window_end_ms"]
    chosen = [running_sum("n", F.lit(1).cast("bigint")), *folds(_empty(stream))]

    def again(window=None) -> list[F.Column]:
        """The folds of folds: merged, or along ``window``."""
        merges = [replace(f, expr=F.col(f.name)).aggregate() for f in chosen]
        return [(m.over(window) if window is not None else m).alias(f.name) for m, f in zip(merges, chosen, strict=True)]

    def partial(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*place, *by).agg(*[f.aggregate().alias(f.name) for f in chosen])

    names = [f.name for f in chosen]
    timed = _empty(stream).withColumn("window_end_ms", F.lit(0).cast("bigint"))
    schema = T.StructType([*_nullable(partial(timed).schema).fields, T.StructField("fired", T.LongType())])

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        rows, trace, clock = _arrived(batch, states, arrival, ts_ms, delay_ms, None)
        tagged = eventtime.late_split(rows, trace, "_arrival", ts_ms, size_ms, lateness_ms)
        held = materialise(states["windows"])
        on_time = partial(tagged.where(F.col("status") == eventtime.ON_TIME))
        waiting = held.where("fired = 0").drop("fired").unionByName(on_time).groupBy(*place).agg(*again())
        # When each waiting window fires, if it does in this micro-batch.
        waiting = materialise(waiting.withColumn("_closes_ms", F.col("window_end_ms") - 1))
        reached = eventtime.first_batch_reaching(waiting, "_closes_ms", trace.withColumnRenamed("_arrival", "_b"), "_b")
        due = materialise(waiting.join(reached, "_closes_ms", "left").drop("_closes_ms"))
        first = due.where("fire_batch is not null").withColumnRenamed("fire_batch", "firing_batch")
        later = partial(tagged.where(F.col("status") == eventtime.REFIRED), "_arrival").withColumnRenamed("_arrival", "firing_batch")
        # A window's firings in this micro-batch, on top of what it had fired before: a row for each arrival at most.
        along = Window.partitionBy(*place).orderBy("firing_batch").rowsBetween(Window.unboundedPreceding, 0)
        local = first.unionByName(later).select(*place, "firing_batch", F.row_number().over(along).cast("bigint").alias("_nth"), *again(along))
        both = _with_state(local, held.where("fired > 0"), place)
        merged = {f.name: f.merge(F.col(f"_held_{f.name}"), F.col(f.name)) for f in chosen}
        firings = materialise(both.withColumns({**merged, "fired": F.col("_nth") + F.coalesce("_held_fired", F.lit(0))}))

        out = firings.select(*place, "firing_batch", (F.col("fired") - 1).cast("int").alias("revision"), *names)
        after = firings.groupBy(*place).agg(F.max_by(F.struct(*names, "fired"), "fired").alias("_s")).select(*place, "_s.*")
        open_still = due.where("fire_batch is null").select(*place, *names, F.lit(0).cast("bigint").alias("fired"))
        untouched = null_safe(held.where("fired > 0"), after.select(*place), place, "left_anti", shuffled=True)
        watermark = _watermark(clock, delay_ms)
        past = F.lit(False) if watermark is None else F.col("window_end_ms") - 1 + lateness_ms <= watermark
        # Windows that nothing changes are written again only to be deleted.
        changed = after.unionByName(open_still).withColumn(GONE, past & (F.col("fired") > 0))
        changed = changed.unionByName(untouched.where(past).withColumn(GONE, F.lit(True)))
        return out, {"clock": _clock_table(batch, clock), "windows": changed}

    return Carried(stream, step, {"clock": (("one",), CLOCK), "windows": (tuple(place), schema)})


def close_windows(states: States) -> DataFrame:
    """What an ended stream's open windows (``states_after``) still have to give, fired after its last arrival."""
    clock = states["clock"].first()
    open_still = states["windows"].where("fired = 0").drop("fired")
    last = F.lit(None if clock is None else clock["arrival"] + 1).cast("bigint")
    return open_still.withColumns({"firing_batch": last, "revision": F.lit(0)})


def tagged(left: DataFrame, right: DataFrame, on: Sequence[str], ts_ms: str, arrival: str | None = None) -> DataFrame:
    """Both inputs of a join as one: ``on``, ``side``, ``ts_ms``, the arrival, and the row in the struct ``left`` or ``right``."""
    shared = [*on, ts_ms, *([arrival] if arrival else [])]

    def side(df: DataFrame, name: str) -> DataFrame:
        own = F.struct(*[c for c in df.columns if c not in shared]).alias(name)
        return df.select(*shared, F.lit(name).alias("side"), own)

    return side(left, LEFT).unionByName(side(right, RIGHT), allowMissingColumns=True)


def interval_join_with_late(
    both: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    before_seconds: float,
    after_seconds: float,
    ts_ms: str,
    delay_ms: int,
    arrival: str | None = None,
) -> Carried:
    """Interval join of the rows on time, with the late rows of either side beside it: one ``output`` column for all three.

    ``both`` is :func:`tagged`. The watermark is the lesser of the two sides', none until both have one; a row
    below it is late, and goes to output ``left`` or ``right`` with ``wm_in``. Output ``pair`` has the structs of both
    rows. Each micro-batch's rows meet each other and the rows kept of the other side, by time buckets. State: per side
    the rows on time that a row still to come may meet; those behind watermark and bound leave it.
    """
    on = list(on)
    buffer = _nullable(T.StructType([*(both.schema[c] for c in (*on, "side", ts_ms)), both.schema[LEFT], both.schema[RIGHT]]))
    reach_ms = {LEFT: round(after_seconds * 1000) + 1, RIGHT: round(before_seconds * 1000) + 1}

    def needed(rows: DataFrame, watermark: int | None) -> DataFrame:
        if watermark is None:
            return rows
        reach = F.when(F.col("side") == LEFT, reach_ms[LEFT]).otherwise(reach_ms[RIGHT])
        return rows.where(F.col(ts_ms) + reach >= watermark)

    def prune(states: States) -> States:
        return states | {"rows": needed(states["rows"], _watermark(states["clock"].first(), delay_ms))}

    def of(rows: DataFrame, side: str) -> DataFrame:
        at = left_ts if side == LEFT else right_ts
        return rows.where(F.col("side") == side).select(*on, F.col(side), F.col(f"{side}.{at}").alias(f"_{side}_at"))

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        held = prune(states)["rows"]
        rows, trace, clock = _arrived(batch, states, arrival, ts_ms, delay_ms, "side")
        seen = eventtime.with_watermark(rows, trace, "_arrival")
        late = F.coalesce(F.col(ts_ms) < F.col("wm_in"), F.lit(False))
        fresh = seen.where(~late).select(*buffer.names)

        def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
            met = interval_join(of(a, LEFT), of(b, RIGHT), on, "_left_at", "_right_at", before_seconds, after_seconds)
            return met.select(*on, LEFT, RIGHT)

        found = pairs(fresh, fresh.unionByName(held)).unionByName(pairs(held, fresh))
        out = found.select(
            F.lit("pair").alias("output"), *on, LEFT, RIGHT, *[F.lit(None).cast("bigint").alias(c) for c in (ts_ms, "wm_in")]
        ).unionByName(seen.where(late).select(F.col("side").alias("output"), *on, LEFT, RIGHT, ts_ms, "wm_in"))
        return out, {"clock": _clock_table(batch, clock), "rows": needed(fresh, _watermark(clock, delay_ms))}

    return Carried(both, step, {"clock": (("one",), CLOCK), "rows": ((), buffer)}, prune)
