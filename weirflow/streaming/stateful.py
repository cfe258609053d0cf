"""Keyed state and timers with ``transformWithState``.

State lives in Spark's checkpointed store, one entry per key. The rows of a key arrive in any
order within a micro-batch, so each processor sorts them by the ``order`` columns first; how many
there can be is set by the size of a micro-batch (``maxBytesPerTrigger`` and the like). Results follow
the order of micro-batches: replay a bounded table with
:func:`weirflow.sources.replay.ordered_stream` for results in event-time order. Inputs have a ``seq``
column that names the record in the output. State and outputs have the type of the value column; null
values leave sums, averages, extremes and counts of values as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirflow.session import ROCKSDB_PROVIDER


def _schema(ddl: str) -> T.StructType:
    """Parsed where the query is built: tasks have no session to parse it."""
    return T.StructType.fromDDL(ddl)


class _Keyed(StatefulProcessor):
    """Shared parts: ordered rows, named output rows, and nothing to release at the end."""

    names: list[str] = []

    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def out(self, *values) -> Row:
        return Row(**dict(zip(self.names, values)))

    def ordered(self, rows: Iterable[Row]) -> list[Row]:
        """Rows without a value in an order column come first."""
        return sorted(rows, key=lambda row: tuple((row[c] is not None, row[c]) for c in self.order))

    def close(self) -> None:
        pass


class ValueFold(_Keyed):
    """One value per key. ``step(value or None, row)`` gives the new value and the rows to emit."""

    def __init__(self, order, schema: str, step: Callable, ttl_ms: int | None = None):
        super().__init__(order)
        self.schema, self.step, self.ttl_ms = _schema(schema), step, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        held = tuple(self.value.get()) if self.value.exists() else None
        for row in self.ordered(rows):
            held, emitted = self.step(held, row)
            yield from (self.out(*key, *values) for values in emitted)
        self.value.update(held)


class TopList(_Keyed):
    """The ``k`` largest values so far, emitted for each record."""

    def __init__(self, order, value: str, k: int, kind: str):
        super().__init__(order)
        self.column, self.k = value, k
        self.schema = _schema(f"v {kind}")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        top = [entry[0] for entry in self.top.get()] if self.top.exists() else []
        for row in self.ordered(rows):
            if row[self.column] is not None:
                top = sorted([*top, row[self.column]], reverse=True)[: self.k]
            yield self.out(*key, row["seq"], list(top))
        self.top.put([(v,) for v in top])


class CountMap(_Keyed):
    """Occurrences of each value so far; a record emits the entry that it changes."""

    def __init__(self, order, value: str, kind: str):
        super().__init__(order)
        self.column = value
        self.key_schema, self.count_schema = _schema(f"v {kind}"), _schema("n bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", self.key_schema, self.count_schema)

    def handleInputRows(self, key, rows, timerValues):
        held: dict = {}
        for row in self.ordered(rows):
            value = row[self.column]
            if value not in held:
                held[value] = self.counts.getValue((value,))[0] if self.counts.containsKey((value,)) else 0
            held[value] += 1
            yield self.out(*key, row["seq"], value, held[value])
        for value, n in held.items():
            self.counts.updateValue((value,), (n,))


class CountWindow(_Keyed):
    """Fires at every ``slide``-th record of a key with its last ``size`` records or fewer."""

    def __init__(self, order, value: str, kind: str, size: int, slide: int | None = None):
        super().__init__(order)
        self.column, self.size, self.slide = value, size, slide or size
        self.value_schema, self.count_schema = _schema(f"v {kind}"), _schema("n bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", self.value_schema)
        self.seen = handle.getValueState("seen", self.count_schema)

    def handleInputRows(self, key, rows, timerValues):
        seen = self.seen.get()[0] if self.seen.exists() else 0
        recent = [entry[0] for entry in self.recent.get()] if self.recent.exists() else []
        for row in self.ordered(rows):
            seen += 1
            recent = [*recent, row[self.column]][-self.size :]
            if seen % self.slide == 0:
                yield self.out(*key, seen // self.slide, len(recent), list(recent))
        self.seen.update((seen,))
        self.recent.put([(v,) for v in recent])


class DelayTimer(_Keyed):
    """A processing-time timer ``delay_ms`` after each record; emits when it fires."""

    def __init__(self, order, delay_ms: int):
        super().__init__(order)
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        for _ in rows:
            self.handle.registerTimer(now + self.delay_ms)
        yield self.out(*key, "registered", now + self.delay_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.out(*key, "fired", expiredTimerInfo.getExpiryTimeInMs())


class EventTimer(_Keyed):
    """An event-time timer at the time in column ``at_ms``; emits when the watermark reaches it."""

    def __init__(self, order, at_ms: str):
        super().__init__(order)
        self.at_ms = at_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for at in {row[self.at_ms] for row in rows}:
            self.handle.registerTimer(at)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.out(*key, expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())


class LateTagger(_Keyed):
    """Tags each row late or not against the watermark that its micro-batch sees."""

    def __init__(self, order, at_ms: str, columns: Sequence[str]):
        super().__init__(order)
        self.at_ms, self.columns = at_ms, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in rows:
            yield self.out(*[row[c] for c in self.columns], bool(row[self.at_ms] < watermark - 1))


class LatenessWindow(_Keyed):
    """Count and sum of one window per key (grouped by key and ``window_end_ms``).

    Emits revision 0 when the watermark passes the end, a further revision for each micro-batch
    with late rows until ``lateness_ms`` later, and after that the late rows themselves.
    """

    def __init__(self, order, value: str, lateness_ms: int):
        super().__init__(order)
        self.column, self.lateness_ms = value, lateness_ms
        self.schema = _schema("n bigint, total bigint, fired bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", self.schema)

    def result(self, key, revision, n, total):
        return self.out(*key, "result", revision, n, total, None)

    def handleInputRows(self, key, rows, timerValues):
        watermark, end = timerValues.getCurrentWatermarkInMs(), key[-1]
        if end + self.lateness_ms <= watermark:
            for row in self.ordered(rows):
                yield self.out(*key, "late", None, None, None, row["seq"])
            return
        n, total, fired = tuple(self.window.get()) if self.window.exists() else (0, 0, 0)
        if end <= watermark and n and not fired:
            yield self.result(key, 0, n, total)
            fired = 1
        for row in rows:
            n, total = n + 1, total + (row[self.column] or 0)
        if end <= watermark:
            yield self.result(key, fired, n, total)
            fired += 1
        else:
            self.handle.registerTimer(end)
        self.handle.registerTimer(end + self.lateness_ms)
        self.window.update((n, total, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.window.exists():
            return
        n, total, fired = self.window.get()
        if not fired:
            yield self.result(key, 0, n, total)
            self.window.update((n, total, 1))
        if expiredTimerInfo.getExpiryTimeInMs() >= key[-1] + self.lateness_ms:
            self.window.clear()


class TopOfWindow(_Keyed):
    """The ``k`` most frequent values of a window; state holds at most ``k`` entries."""

    def __init__(self, order, k: int):
        super().__init__(order)
        self.k = k
        self.schema = _schema("n bigint, v int")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        best = [tuple(entry) for entry in self.best.get()] if self.best.exists() else []
        for row in rows:
            best = sorted([*best, (row["n"], row["vc"])], key=lambda e: (-e[0], e[1]))[: self.k]
        self.best.put(best)
        self.handle.registerTimer(key[0] + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for rank, (n, value) in enumerate(self.best.get(), 1):
            yield self.out(*key, value, n, rank)
        self.best.clear()


def _apply(
    stream: DataFrame,
    keys: Sequence[str],
    processor: _Keyed,
    columns: str,
    time_mode: str = "None",
    reads: Sequence[str] = (),
) -> DataFrame:
    """``reads`` names the columns the processor needs; nothing else is sent to it."""
    schema = T.StructType([stream.schema[k] for k in keys] + _schema(columns).fields)
    if reads:
        stream = stream.select(*dict.fromkeys([*keys, *processor.order, "seq", *reads]))
    return _transform(stream, keys, processor, schema, time_mode)


def _transform(stream: DataFrame, keys, processor: _Keyed, schema: T.StructType, time_mode: str) -> DataFrame:
    store = stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if store != ROCKSDB_PROVIDER:
        raise ValueError("keyed state needs the RocksDB state store: call weirflow.session.use_keyed_state_store first")
    processor.names = schema.fieldNames()
    return stream.groupBy(*keys).transformWithState(processor, schema, "append", time_mode)


def _kind(stream: DataFrame, value: str) -> str:
    return stream.schema[value].dataType.simpleString()


def _sum_kind(stream: DataFrame, value: str) -> str:
    """Whole numbers are summed as bigint, decimals in a wider decimal, floats as double."""
    kind = stream.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        return f"decimal({min(38, kind.precision + 10)},{kind.scale})"
    return "double" if isinstance(kind, (T.FloatType, T.DoubleType)) else "bigint"


def jumps(stream: DataFrame, keys, order, value: str, limit: int) -> DataFrame:
    """Records that differ from the key's last one by more than ``limit`` (first: from 0; null values from nothing)."""

    def step(held, row):
        last, now = (held[0] if held and held[0] is not None else 0), row[value]
        return (now,), ([(row["seq"], now, last)] if now is not None and abs(now - last) > limit else [])

    kind = _kind(stream, value)
    processor = ValueFold(order, f"last {kind}", step)
    return _apply(stream, keys, processor, f"seq bigint, {value} {kind}, prev_{value} {kind}", reads=[value])


def running_sum(stream: DataFrame, keys, order, value: str) -> DataFrame:
    def step(held, row):
        total, now = (held[0] if held else None), row[value]
        total = now if total is None else total if now is None else total + now
        return (total,), [(row["seq"], total)]

    kind = _sum_kind(stream, value)
    processor = ValueFold(order, f"total {kind}", step)
    return _apply(stream, keys, processor, f"seq bigint, sum_{value} {kind}", reads=[value])


def running_average(stream: DataFrame, keys, order, value: str) -> DataFrame:
    def step(held, row):
        (total, n), now = held or (0, 0), row[value]
        total, n = (total, n) if now is None else (total + now, n + 1)
        return (total, n), [(row["seq"], float(total) / n if n else None)]

    processor = ValueFold(order, f"total {_sum_kind(stream, value)}, n bigint", step)
    return _apply(stream, keys, processor, f"seq bigint, avg_{value} double", reads=[value])


def reduced(stream: DataFrame, keys, order, schema: str, columns: str, step: Callable) -> DataFrame:
    """General reduce: ``step(value or None, row)`` returns the new value and the rows to emit."""
    return _apply(stream, keys, ValueFold(order, schema, step), columns)


def record_counter(stream: DataFrame, keys, order) -> DataFrame:
    """0, 1, 2, ... per key, going on where a restarted query left off."""

    def step(held, row):
        n = held[0] if held else 0
        return (n + 1,), [(row["seq"], n)]

    return _apply(stream, keys, ValueFold(order, "n bigint", step), "seq bigint, counter bigint", reads=["seq"])


def last_with_ttl(stream: DataFrame, keys, order, value: str, ttl_ms: int) -> DataFrame:
    """The key's last value, or 0 once it has not been written for ``ttl_ms`` of processing time."""

    def step(held, row):
        return (row[value],), [(row["seq"], held[0] if held else 0)]

    kind = _kind(stream, value)
    processor = ValueFold(order, f"last {kind}", step, ttl_ms)
    return _apply(stream, keys, processor, f"seq bigint, last_{value} {kind}", "ProcessingTime", [value])


def global_window(stream: DataFrame, keys, order, value: str, fire_when: Callable[[int], bool]) -> DataFrame:
    """One endless window per key; fires with its count and sum where ``fire_when(count)``."""

    def step(held, row):
        (n, total), now = held or (0, None), row[value]
        n, total = n + 1, now if total is None else total if now is None else total + now
        return (n, total), ([(row["seq"], n, total)] if fire_when(n) else [])

    kind = _sum_kind(stream, value)
    processor = ValueFold(order, f"n bigint, total {kind}", step)
    return _apply(stream, keys, processor, f"seq bigint, n bigint, sum_{value} {kind}", reads=[value])


def top_so_far(stream: DataFrame, keys, order, value: str, k: int = 3) -> DataFrame:
    kind = _kind(stream, value)
    return _apply(stream, keys, TopList(order, value, k, kind), f"seq bigint, top array<{kind}>", reads=[value])


def value_counts_so_far(stream: DataFrame, keys, order, value: str) -> DataFrame:
    """For each record the entry of its key's value-to-count map that it changes, after the change."""
    kind = _kind(stream, value)
    return _apply(stream, keys, CountMap(order, value, kind), f"seq bigint, {value} {kind}, n bigint", reads=[value])


def count_windows(stream: DataFrame, keys, order, value: str, size: int, slide: int | None = None) -> DataFrame:
    kind = _kind(stream, value)
    processor = CountWindow(order, value, kind, size, slide)
    return _apply(stream, keys, processor, f"window_no bigint, n bigint, elements array<{kind}>", reads=[value])


def delay_timers(stream: DataFrame, keys, delay_ms: int) -> DataFrame:
    return _apply(stream, keys, DelayTimer([], delay_ms), "event string, at_ms bigint", "ProcessingTime")


def event_timers(stream: DataFrame, keys, at_ms: str) -> DataFrame:
    """Timers of a watermarked stream whose watermark column was projected away."""
    return _apply(stream, keys, EventTimer([], at_ms), "timer_ms bigint, wm_ms bigint", "EventTime")


def late_tagged(stream: DataFrame, keys, at_ms: str) -> DataFrame:
    """Each row with ``late``. The watermark column must be projected away after
    ``withWatermark``, otherwise Spark drops late rows before they can be tagged."""
    schema = T.StructType([*stream.schema.fields, T.StructField("late", T.BooleanType())])
    return _transform(stream, keys, LateTagger([], at_ms, stream.columns), schema, "EventTime")


def allowed_lateness(stream: DataFrame, keys, order, value: str, lateness_ms: int) -> DataFrame:
    """Window results with revisions (``event = 'result'``) and late rows (``'late'``).

    The stream has ``window_end_ms`` and no watermark column (see :func:`late_tagged`).
    """
    columns = "event string, revision bigint, n bigint, sum_vc bigint, late_seq bigint"
    processor = LatenessWindow(order, value, lateness_ms)
    return _apply(stream, [*keys, "window_end_ms"], processor, columns, "EventTime")


def top_of_windows(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values per window from a stream of closed counts per window and value."""
    columns = "vc int, n bigint, rank int"
    return _apply(counts, ["window_end_ms"], TopOfWindow([], k), columns, "EventTime")
