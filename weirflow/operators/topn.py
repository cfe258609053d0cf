"""Top-N values by frequency per time window. Ties: larger count first, then smaller value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.operators.windows import time_windows


def _ranked(counts: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col(value).asc())
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_values(df: DataFrame, ts: str, value: str, k: int, size: str, slide: str) -> DataFrame:
    """Over all keys: count each value per window, keep the ``k`` most frequent.

    The rank filter is applied in each map task before the shuffle as well.
    """
    counts = time_windows(df, [value], ts, size, slide, n=F.count(F.lit(1)))
    return _ranked(counts, ["window_start", "window_end"], value, k)


def top_values_two_stage(
    df: DataFrame, ts: str, value: str, k: int, size: str, slide: str, salts: int = 32
) -> DataFrame:
    """The same result where one window may hold very many distinct values.

    Values are first ranked within ``salts`` shares of each window, in parallel, and only the
    winners of the shares are ranked against each other.
    """
    counts = time_windows(df, [value], ts, size, slide, n=F.count(F.lit(1)))
    salted = counts.withColumn("_share", F.pmod(F.xxhash64(value), F.lit(salts)))
    winners = _ranked(salted, ["window_start", "window_end", "_share"], value, k).drop("_share", "rank")
    return _ranked(winners, ["window_start", "window_end"], value, k)
