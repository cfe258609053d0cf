"""Comma-separated lines to typed records."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record layouts of the line formats.
SENSOR = "id string, ts bigint, vc int"
LEFT_EVENT = "key string, sec int"
RIGHT_EVENT = "key string, sec int, n int"

FAILFAST, DROP, QUARANTINE = "failfast", "drop", "quarantine"


def parse_records(lines: DataFrame, schema: str = SENSOR, policy: str = FAILFAST, line: str = "value") -> DataFrame:
    """Split each line at commas and cast the fields to ``schema`` (extra fields are ignored).

    ``failfast``: a bad or missing field fails the job. ``drop``: the line is left out.
    ``quarantine``: the fields that do not parse are null and ``bad_line`` holds the whole line.
    """
    fields = T.StructType.fromDDL(schema).fields
    parts = F.split(F.col(line), ",")
    if policy == FAILFAST:
        # Fails whatever the session's ANSI setting is.
        fail = F.raise_error(F.concat(F.lit("bad line: "), F.coalesce(line, F.lit("null"))))
        tried = [F.try_element_at(parts, F.lit(i + 1)).try_cast(f.dataType) for i, f in enumerate(fields)]
        return lines.select(
            *[F.when(t.isNull(), fail.cast(f.dataType)).otherwise(t).alias(f.name) for t, f in zip(tried, fields)]
        )
    if policy not in (DROP, QUARANTINE):
        raise ValueError(f"unknown policy {policy}")
    # Exploding a single array keeps the filter on the fields from splitting each line again.
    once = lines.select(line, F.explode(F.array(parts)).alias("_parts"))
    typed = [
        F.try_element_at("_parts", F.lit(i + 1)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)
    ]
    parsed = once.select(line, *typed)
    bad = reduce(or_, [F.col(f.name).isNull() for f in fields])
    if policy == DROP:
        return parsed.where(~bad).drop(line)
    return parsed.withColumn("bad_line", F.when(bad, F.col(line))).drop(line)
