"""Splitting one input into several outputs in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIN = "main"


def route(df: DataFrame, tags: dict[str, Column], column: str = "tag") -> DataFrame:
    """Tag each row with the first matching condition, or ``main``; a row has exactly one tag."""
    chosen = F.lit(None).cast("string")
    for tag, condition in reversed(tags.items()):
        chosen = F.when(condition, F.lit(tag)).otherwise(chosen)
    return df.withColumn(column, F.coalesce(chosen, F.lit(MAIN)))


def output(routed: DataFrame, tag: str = MAIN, column: str = "tag") -> DataFrame:
    return routed.where(F.col(column) == tag).drop(column)


def split(df: DataFrame, **conditions: Column) -> dict[str, DataFrame]:
    """Independent filters over one input; a row may appear in none or in several."""
    return {name: df.where(condition) for name, condition in conditions.items()}


def beside_main(df: DataFrame, tags: dict[str, Column], column: str = "tag") -> DataFrame:
    """Each row once as ``main``, and once more for each tag whose condition it meets, in one pass.

    For streams: the main output stays whole beside its side outputs.
    """
    met = [F.when(condition, F.lit(tag)) for tag, condition in tags.items()]
    return df.withColumn(column, F.explode(F.array_compact(F.array(F.lit(MAIN), *met))))


def with_alerts(df: DataFrame, condition: Column, message: Column) -> tuple[DataFrame, DataFrame]:
    """The untouched input, and a message for each row that meets ``condition``."""
    return df, df.where(condition).withColumn("message", message)


def above(value: str, limit: int) -> tuple[Column, Column]:
    """Condition and message of a threshold alert."""
    # Fixed value: the wording of the alert.
    text = F.concat(
        F.lit("Current Vc="), F.col(value).cast("string"), F.lit(" ,is greater than "), F.lit(str(limit))
    )
    return F.col(value) > limit, text
