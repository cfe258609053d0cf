"""Scalar and predicate columns shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_id(wanted) -> Column:
    """Reusable predicate: the record's ``id`` equals ``wanted`` (a null id never matches)."""
    return F.col("id") == F.lit(wanted)


def is_even(number: Column) -> Column:
    return number % 2 == 0


def is_odd(number: Column) -> Column:
    """Remainder keeps the sign of the number, so negative odd values are not matched."""
    return number % 2 == 1


def words(line: Column) -> Column:
    """Split a line at single spaces; trailing empty words are dropped, inner ones are kept.

    A line made only of spaces has no words; an empty line has one empty word.
    """
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def parse_int(text: Column, strict: bool = True) -> Column:
    """Text to int: ``strict`` fails the job on bad text, otherwise bad text becomes null."""
    return text.cast("int") if strict else text.try_cast("int")


def value_or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def labelled_number(number: Column) -> Column:
    # Fixed value: the prefix of generated records.
    return F.concat(F.lit("Number: "), number.cast("string"))
