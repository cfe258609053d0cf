"""Full windows of streams: all elements of each window, in pages, once the watermark has passed its end.

The rows of open windows are a log in the shared folder (:mod:`weirflow.streaming.carried`), not objects of a state
store. A window that closes is read from there once, numbered along its order with hot windows cut, and given out page
by page; its rows leave the log with the next snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.times import ordinal
from weirflow.operators import windows
from weirflow.operators.running import SLICE_ROWS
from weirflow.streaming.carried import Carried, States, _empty, _nullable
from weirflow.streaming.sessions import CLOCK, MICROS, _clock, _clock_table

END = "_end_us"


def _passed(at: int | None, delay_seconds: int) -> Column:
    """Whether the watermark, with ``at`` the largest event time so far, has passed the end of a row's window."""
    return F.lit(False) if at is None else F.col(END) <= at - delay_seconds * MICROS


def window_elements(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    size_seconds: int,
    order: Sequence[str],
    element: Column,
    delay_seconds: int,
    page_rows: int = 1000,
    slice_rows: int = SLICE_ROWS,
) -> Carried:
    """The pages of :func:`weirflow.operators.windows.window_elements`, each window once, when it closes.

    A row whose window had closed before its micro-batch is late and in no page
    (:func:`weirflow.streaming.late.late_split` gives such rows out); rows without a time are in none either. State: the
    rows of open windows; :func:`open_windows` gives the windows of a stream that has ended.
    """
    columns = list(dict.fromkeys([*keys, ts, *order]))

    def placed(rows: DataFrame) -> DataFrame:
        at = ordinal(rows, ts)
        end = at - F.pmod(at, F.lit(size_seconds * MICROS)) + size_seconds * MICROS
        return rows.where(F.col(ts).isNotNull()).select(*columns, element.alias("_element"), end.alias(END))

    schema = _nullable(placed(_empty(stream)).schema)

    def pages(rows: DataFrame) -> DataFrame:
        size = f"{size_seconds} seconds"
        out = windows.window_elements(rows, keys, ts, size, order, F.col("_element"), page_rows, slice_rows)
        return out.select(*keys, "window_start", "window_end", "page", "n", "elements")

    def prune(states: States) -> States:
        held = states["clock"].first()
        return states | {"rows": states["rows"].where(~_passed(held and held["at"], delay_seconds))}

    def step(batch: DataFrame, states: States) -> tuple[DataFrame, States]:
        held = states["clock"].first()
        before, at = _passed(held and held["at"], delay_seconds), _clock(batch, ts, states)
        fresh = placed(batch).where(~before)
        now = _passed(at, delay_seconds)
        waiting = states["rows"].where(~before)
        closing = waiting.unionByName(fresh).where(now)
        return pages(closing), {"clock": _clock_table(batch, at), "rows": fresh.where(~now)}

    return Carried(stream, step, {"clock": (("one",), CLOCK), "rows": ((), schema)}, prune)


def open_windows(keyed: Carried, states: States, keys: Sequence[str], ts: str, size_seconds: int, order: Sequence[str], page_rows: int = 1000) -> DataFrame:
    """The pages of the windows that were open when the stream ended; ``states`` are ``states_after`` its last micro-batch."""
    rows = keyed.prune(states)["rows"]
    out = windows.window_elements(rows, keys, ts, f"{size_seconds} seconds", order, F.col("_element"), page_rows)
    return out.select(*keys, "window_start", "window_end", "page", "n", "elements")
