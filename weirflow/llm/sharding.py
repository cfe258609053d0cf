"""Shards of near equal bytes by sampled splitters.

Records are put in the order of a key. A sample of keys, drawn with a chance in proportion to the size of
the record, gives the quantiles at which the order is cut into ranges; then every range is measured exactly,
and a range that holds more than ``range_bytes`` (or half a shard) is cut again by a sample of its own, until none is overfull.
A range is what one task sorts, so no task has more than that, however many records share a key: ties are told
apart by a hash of the record and by its place in the written input, and a single record is never cut.

The sums of the ranges before it tell each record where its bytes lie among all bytes, and that decides
its shard: the middle of a record that lies in the k-th of ``shards`` equal parts puts it into shard k. So
shards are consecutive stretches of the key's order, and two of them differ by less than two of the largest
records, whatever the samples were; they only decide where work is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import stored
from weirflow.session import broadcast_if_small

RANGE_BYTES = 64 << 20
# Parts that a range is cut into at once, and sampled keys for each part.
PARTS, SAMPLED = 64, 32
#: What a record takes beside its text.
RECORD_BYTES = 8


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none where it is null), and a fixed part for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + RECORD_BYTES


def _cuts(rows: DataFrame, ranges: Sequence[str], range_bytes: int) -> DataFrame:
    """Splitters of each overfull range, at most ``PARTS - 1``, in one row; its sample has ``SAMPLED * PARTS`` keys on average."""
    sized = rows.groupBy(*ranges).agg(F.sum("size").alias("_bytes"), F.max("size").alias("_largest"))
    # Without its largest record: what is left of a range with one huge record may be cut, the record may not.
    overfull = stored(sized.where(F.col("_bytes") - F.col("_largest") > range_bytes))
    parts = F.least(F.lit(PARTS), F.ceil(2 * F.col("_bytes") / range_bytes))
    chance = F.col("size") * SAMPLED * parts / F.col("_bytes")
    # The draw depends on the record and the level alone, so a repeated task draws the same sample.
    drawn = F.pmod(F.xxhash64("order", F.lit(len(ranges))), F.lit(1 << 30)) / (1 << 30) < chance
    sample = rows.join(broadcast_if_small(overfull), list(ranges)).where(drawn).select(*ranges, parts.alias("_parts"), "order")
    keys = sample.groupBy(*ranges, "_parts").agg(F.sort_array(F.collect_list("order")).alias("_keys"))
    wanted = F.sequence(F.lit(1), F.col("_parts").cast("int") - 1)
    at = F.transform(wanted, lambda k: F.col("_keys")[F.floor(k * F.size("_keys") / F.col("_parts")).cast("int")])
    return stored(keys.select(*ranges, F.array_distinct(at).alias("_splitters")))


def into_ranges(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, list[str]]:
    """``rows`` (``order``, ``size``) with the range columns that bound a group's bytes, coarse to fine.

    Columns compare like ``order``. A splitter has a range of its own, so every cut makes ranges smaller.
    """
    ranges = ["_range0"]
    rows = rows.withColumn("_range0", F.lit(0))
    while True:
        # Nothing but the columns that place a record is read while ranges are measured.
        cuts = _cuts(rows.select("order", "size", *ranges), ranges, range_bytes)
        if cuts.isEmpty():
            return rows, ranges
        name = f"_range{len(ranges)}"
        below = F.size(F.filter("_splitters", lambda s: s < F.col("order")))
        up_to = F.size(F.filter("_splitters", lambda s: s <= F.col("order")))
        number = F.when(F.col("_splitters").isNull(), 0).otherwise(below + up_to + 1)
        rows = rows.join(broadcast_if_small(cuts), list(ranges), "left").withColumn(name, number).drop("_splitters")
        ranges.append(name)


def _before(ranges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``ranges`` with the bytes and rows of all ranges before each: sums inside the coarse range, and of coarse ranges."""
    if len(columns) == 1:
        upper, inner = ranges.select(*columns, F.lit(0).alias("_b"), F.lit(0).alias("_r")), Window.partitionBy(*columns)
    else:
        totals = ranges.groupBy(*columns[:-1]).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        upper = _before(totals, columns[:-1]).select(*columns[:-1], F.col("bytes_before").alias("_b"), F.col("rows_before").alias("_r"))
        inner = Window.partitionBy(*columns[:-1])
    along = inner.orderBy(columns[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = {
        f"{name}_before": F.coalesce(F.sum(name).over(along), F.lit(0)) + F.col(f"_{name[0]}") for name in ("bytes", "rows")
    }
    return ranges.join(upper, list(columns[:-1]) or list(columns)).withColumns(sums).drop("_b", "_r")


def shard(
    docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``(doc, size, shard, slot)``, one row for each row of ``docs``, whose columns are in the struct ``doc``.

    ``size`` is :func:`record_size` of ``text``. ``slot`` numbers the records of a shard from 0 without gaps,
    along the key. Null keys come first; records of one key are in the order of their hash, so that any number
    of them may be cut apart; equal rows are told apart by their place in the input and share nothing else.
    Null and empty texts only have the fixed part. A record larger than a shard's share is alone in its stretch, and
    shards that lie wholly inside it are empty. An empty table has no rows. Maps in ``docs`` are not supported.
    """
    whole = docs.select(F.struct("*").alias("doc"))
    order = F.struct(F.col(f"doc.`{key}`").alias("key"), F.xxhash64("doc").alias("tie"), F.monotonically_increasing_id().alias("place"))
    # Written first: places and sizes are then the same for every later reader, also after a lost executor.
    rows = stored(whole.select("doc", record_size(F.col(f"doc.`{text}`")).alias("size"), order.alias("order")))
    total = rows.agg(F.sum("size")).first()[0] or 1
    placed, ranges = into_ranges(rows, min(range_bytes, total // (2 * shards)))
    measured = stored(placed.groupBy(*ranges).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    starts = broadcast_if_small(stored(_before(measured, ranges).drop("bytes", "rows")))
    along = Window.partitionBy(*ranges).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)

    def numbered(some: DataFrame) -> DataFrame:
        """Records with their number among all and their shard."""
        at = some.join(starts, ranges).withColumns(
            {
                "_b": F.col("bytes_before") + F.coalesce(F.sum("size").over(along), F.lit(0)),
                "_n": F.col("rows_before") + F.count("*").over(along),
            }
        )
        # In decimals, as twice the bytes times the shards may pass a bigint; whole numbers, so nothing is rounded.
        middle = f"(cast(2 * _b + size as decimal(20,0)) * {shards}) div cast({2 * total} as decimal(20,0))"
        return at.withColumn("shard", F.least(F.expr(middle), F.lit(shards - 1)).cast("int"))

    # The first number of each shard, from the narrow columns; then the records themselves go to their ranges.
    firsts = stored(numbered(placed.drop("doc")).groupBy("shard").agg(F.min("_n").alias("_first")))
    out = numbered(placed).join(broadcast_if_small(firsts), "shard")
    return out.select("doc", "size", "shard", (F.col("_n") - F.col("_first")).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the records as Parquet, a folder ``shard=<k>`` for each shard; every file is a stretch of its slots.

    A task writes the ranges that it has sorted, so nothing is shuffled again.
    """
    sharded.select("doc.*", F.col("slot").alias("_slot"), "shard").write.partitionBy("shard").parquet(path)
