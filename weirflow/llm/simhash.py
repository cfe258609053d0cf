"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's word shingles. Two
fingerprints link at a Hamming distance of at most ``radius`` (2 or 3). Both ends of a link emit the
variants within half the radius of themselves, and linked ends meet on a common variant:

* every fingerprint emits its ball of radius 1 (itself and 64 one-bit variants);
* at radius 3 one of the two ends has an even number of set bits, and the ends differ in three bits, two of
  which lie in the same half of the word. So only even fingerprints emit two-bit variants, and only those
  with both bits in one half: 992 instead of 2016.

All members of a variant's group lie within ``radius`` of any member that emitted the variant from its
radius-1 ball, so one star around the smallest such member keeps every link's ends connected. A group is
linear in its members, and its size is bounded by the geometry of the ball (65 + 992 fingerprints).

Before balls are emitted, fingerprints that can't have a link are set aside: ends of a link agree in at
least three of six blocks of their bits, so a fingerprint that is alone on all twenty triples of blocks
is linked to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import components, stored, with_type

SEED = 42
WORDS_AT_ONCE = 100_000
BLOCK_BITS = (11, 11, 11, 11, 10, 10)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 where it has no word.

    Words are what lies between ASCII white space, with A-Z lower-cased. Shingles count as often as they
    occur; a text with fewer words than ``shingle`` has one shingle of all its words.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    counts = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE + size - 1]
        grams = zip(*(part[k : len(part) - size + 1 + k] for k in range(size)), strict=True)
        raw = b"".join([digest(join(gram), SEED) for gram in grams])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big"))


def _prints(texts: pa.Array, shingle: int) -> pa.Array:
    """Fingerprints of a column, with few of its texts in Python at a time."""
    parts = (texts.slice(at, 256).cast(pa.binary()).to_pylist() for at in range(0, len(texts), 256))
    return pa.array([fingerprint(x, shingle) for part in parts for x in part], pa.int64())


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fingerprint bigint)`` for each row of ``docs`` (``doc_id``, ``text``)."""
    schema = T.StructType([with_type(docs, "doc_id"), T.StructField("fingerprint", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _prints(batch.column(1), shingle)], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def _variants(of: Column, masks: list[int]) -> Column:
    flips = F.array(*[F.lit(_signed(m)) for m in masks])
    return F.explode(F.transform(flips, lambda m: of.bitwiseXOR(m)))


def with_company(prints: DataFrame) -> DataFrame:
    """The fingerprints that agree with another one in at least three of six blocks of bits."""
    starts = [sum(BLOCK_BITS[:k]) for k in range(len(BLOCK_BITS))]
    blocks = [((1 << n) - 1) << s for n, s in zip(BLOCK_BITS, starts, strict=True)]
    masks = [_signed(a | b | c) for a, b, c in combinations(blocks, 3)]
    fp = F.col("fingerprint")
    keys = F.array(*[F.xxhash64(fp.bitwiseAND(F.lit(m)), F.lit(k)) for k, m in enumerate(masks)])
    keyed = prints.select("fingerprint", F.explode(keys).alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
        .where("low != high")
        .select("key")
    )
    return keyed.join(shared, "key", "left_semi").select("fingerprint").distinct()


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)``: verified links that connect all distinct ``prints`` within ``radius`` of each other."""
    if radius not in (2, 3):
        raise ValueError("radius must be 2 or 3")
    fp = F.col("fingerprint")
    near = [0, *(1 << k for k in range(64))]
    balls = prints.select("fingerprint", _variants(fp, near).alias("variant"), F.lit(True).alias("inner"))
    if radius == 3:
        halves = (range(32), range(32, 64))
        far = [1 << i | 1 << j for half in halves for i, j in combinations(half, 2)]
        even = prints.where(F.bit_count(fp) % 2 == 0)
        balls = balls.union(even.select("fingerprint", _variants(fp, far).alias("variant"), F.lit(False).alias("inner")))
    centre = F.min(F.when(F.col("inner"), fp)).over(Window.partitionBy("variant"))
    return (
        balls.select("fingerprint", centre.alias("centre"))
        .where("fingerprint != centre")
        .where(F.bit_count(fp.bitwiseXOR(F.col("centre"))) <= radius)
        .select(F.col("fingerprint").alias("a"), F.col("centre").alias("b"))
        .distinct()
    )


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """``(fingerprint, root, first)`` for each distinct fingerprint: its component and its smallest doc_id."""
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    labels = components(links(stored(with_company(classes)), radius))
    return classes.join(labels, classes["fingerprint"] == labels["node"], "left").select(
        "fingerprint", F.coalesce("label", "fingerprint").alias("root"), "first"
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links. Texts that are null, empty or
    blank have fingerprint 0, which is linked like any other. Repeated rows have equal rows; a null doc_id
    never names a component unless all its members are null. Other columns of ``docs`` are not read.
    """
    prints = stored(fingerprints(docs, shingle))
    rooted = _rooted(prints, radius)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component, that with the smallest doc_id.

    Rows without a doc_id come last. Where the smallest doc_id is repeated within a component, the row with
    the smallest fingerprint stays, and of rows equal in that too the first in the order of their JSON form.
    """
    prints = stored(fingerprints(docs, shingle))
    members = prints.join(_rooted(prints, radius).select("fingerprint", "root"), "fingerprint")
    counted = members.groupBy("root", "doc_id", "fingerprint").agg(F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fingerprint", "rows")
    best = stored(
        counted.groupBy("root")
        .agg(F.min(order).alias("b"))
        .select(F.col("b.doc_id").alias("_id"), F.col("b.fingerprint").alias("_print"), F.col("b.rows").alias("_rows"))
    )

    @F.arrow_udf("bigint")
    def print_of(texts: pa.Array) -> pa.Array:
        return _prints(texts, shingle)

    marked = docs.select(F.struct("*").alias("doc"), print_of("text").alias("print"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print"))
    single = marked.join(best.where("_rows = 1"), same, "left_semi").select("doc.*")
    repeated = best.where("_rows > 1")
    if repeated.isEmpty():
        return single
    first = Window.partitionBy("doc.doc_id", "print").orderBy(F.to_json("doc"))
    several = marked.join(repeated, same, "left_semi").withColumn("nth", F.row_number().over(first))
    return single.unionByName(several.where("nth = 1").select("doc.*"))
