"""Helpers that the text operators share: written tables, Arrow columns, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.session import shared_dir


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    The written table cuts the lineage: a lost executor never makes Spark repeat what lies before it, and
    rows that a Python stage produced are the same for every later reader.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/weirflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict[tuple, Any] = {}


def held(owner: tuple, make: Callable[[], Any]) -> Any:
    """What an operator keeps in this Python process from task to task, made by ``make`` when first asked for.

    Spark uses its Python workers again for other operators. So a process holds one owner's things at a time: another
    owner's are let go first, and their memory is given back to the system.
    """
    if owner not in _held:
        release()
        _held[owner] = make()
    return _held[owner]


def release() -> None:
    """Let go of whatever :func:`held` has kept in this Python process."""
    if not _held:
        return
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # not every C library has it
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_type(df: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """A nullable field of the type that ``column`` has in ``df``."""
    return T.StructField(name or column, df.schema[column].dataType, True)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column's strings as UTF-8 bytes, without decoding them."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``(node, label)`` for every node of an edge, ``label`` its smallest node.

    ``edges`` has two bigint columns ``a`` and ``b``. Large-star and small-star steps alternate until the
    edges stop changing; then every node points at its root. Minima are aggregated before they are joined
    back, so a node with very many edges is never gathered in one task by an aggregate.
    """
    current = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _fingerprint(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u")
            .where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        current = stored(small)
        previous, mark = mark, _fingerprint(current)
        if mark == previous:
            return current.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
