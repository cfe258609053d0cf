"""Physical routing of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_by_key(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """All rows of a key in one partition; a partition holds many keys.

    Only for consumers that need this placement. Aggregations and joins place rows themselves
    and pre-aggregate or split hot keys, which this cannot.
    """
    return df.repartition(partitions, *keys)


def sorted_runs(df: DataFrame, group: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of a group next to each other, for Python work along them.

    The number of partitions is given, because AQE would join small ones although the work per
    row is heavy.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *group).sortWithinPartitions(*group, *order)


def route_by_rule(df: DataFrame, partitions: int, rule: Column) -> DataFrame:
    """Rows to the partition number that ``rule`` computes (taken modulo ``partitions``)."""
    return df.repartitionById(partitions, F.pmod(rule, F.lit(partitions)).cast("int"))


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin redistribution that evens out a skewed source."""
    return df.repartition(partitions)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a source that has fewer splits than there are cores; leave any other as it is.

    For heavy work per row on a few files. A large table has enough splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return rebalance(df, cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_rows(df: DataFrame, partitions: int, seed: int = 0) -> DataFrame:
    """Random redistribution (seeded, so that a retried task places its rows again alike)."""
    return df.repartition(partitions, F.rand(seed))


def rescale(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions by merging neighbours, without a shuffle."""
    return df.coalesce(partitions)


def replicate(df: DataFrame, copies: int) -> DataFrame:
    """Every row to each of ``copies`` receivers, numbered by ``copy``."""
    numbers = F.sequence(F.lit(0), F.lit(copies - 1))
    return df.withColumn("copy", F.explode(numbers))
