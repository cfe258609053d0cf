"""Union of like inputs and connection of unlike ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*inputs: DataFrame) -> DataFrame:
    """Bag union of two or more inputs with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), inputs)


def connect_map(
    left: DataFrame, right: DataFrame, left_map: dict[str, Column], right_map: dict[str, Column], source: str = "src"
) -> DataFrame:
    """Map two inputs of different types, each on its own, to common columns and unite them."""
    if set(left_map) != set(right_map):
        raise ValueError("both sides must be mapped to the same columns")

    def side(df: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
        return df.select(F.lit(name).alias(source), *[c.alias(n) for n, c in columns.items()])

    return side(left, left_map, "left").unionByName(side(right, right_map, "right"))
