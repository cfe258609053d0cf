"""Token ids in patched frame-of-reference segments, written by Spark in doc_id order and read back.

A segment holds whole documents and looks like this (all numbers little-endian):

* ``WFP1``, then the number of ids and of blocks (unsigned 32 bits each);
* for all blocks their minima (32 bits), widths and numbers of exceptions (8 bits each);
* the index: the byte at which each block starts in the payload, and the end (32 bits each);
* the payload. A block of 128 ids is its ids less the minimum, cut to ``width`` bits and packed into two
  lanes of 64 values, then the places (8 bits) and values (32 bits) of the exceptions: ids whose distance
  from the minimum needs more bits than nine tenths of the block's do.

Segments are rows of a Parquet table, so that Spark's committed writes hold on any store and a task that is
run again leaves nothing twice. Each row also names its documents and their numbers of ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import stored, with_type
from weirflow.llm.tokens import ID_BYTES, encoder

MAGIC = b"WFP1"
BLOCK = 128
LANE = 64
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 18
BROADCAST_ROWS = 100_000


def encode(ids: np.ndarray) -> bytes:
    """A segment of ``ids`` (unsigned 32-bit)."""
    blocks = -(-len(ids) // BLOCK)
    filled = np.zeros(blocks * BLOCK, np.uint32)
    filled[: len(ids)] = ids
    filled[len(ids) :] = ids[-1] if len(ids) else 0
    values = filled.reshape(blocks, BLOCK)
    low = values.min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = values - low[:, None]
    usual = np.sort(delta, axis=1)[:, int(PERCENTILE * (BLOCK - 1))]
    width = np.frexp(usual.astype(np.float64))[1].astype(np.int64)
    odd = delta >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_odd = odd.sum(axis=1)
    size = 2 * LANE // 8 * width + (1 + ID_BYTES) * n_odd
    start = np.concatenate(([0], np.cumsum(size)))
    payload = np.zeros(int(start[-1]), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = _packed(delta[rows] & np.uint32((1 << w) - 1), w)
        payload[start[rows][:, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(odd)
    if len(row):
        rank = np.arange(len(row)) - np.concatenate(([0], np.cumsum(n_odd)))[row]
        first = start[row] + 2 * LANE // 8 * width[row]
        payload[first + rank] = place
        raw = delta[row, place].astype("<u4").view(np.uint8).reshape(-1, ID_BYTES)
        payload[(first + n_odd[row] + ID_BYTES * rank)[:, None] + np.arange(ID_BYTES)] = raw
    head = [np.array([len(ids), blocks], "<u4"), low.astype("<u4"), width.astype(np.uint8), n_odd.astype(np.uint8), start.astype("<u4")]
    return MAGIC + b"".join(x.tobytes() for x in head) + payload.tobytes()


def decode(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (exclusive; all without it), read by the index."""
    if segment[:4] != MAGIC:
        raise ValueError("not a segment")
    n, blocks = np.frombuffer(segment, "<u4", 2, 4).tolist()
    at = 12
    low = np.frombuffer(segment, "<u4", blocks, at)
    width = np.frombuffer(segment, np.uint8, blocks, at + 4 * blocks).astype(np.int64)
    n_odd = np.frombuffer(segment, np.uint8, blocks, at + 5 * blocks).astype(np.int64)
    start = np.frombuffer(segment, "<u4", blocks + 1, at + 6 * blocks).astype(np.int64)
    payload = np.frombuffer(segment, np.uint8, offset=at + 10 * blocks + 4)
    pick = slice(first, blocks if last is None else min(last, blocks))
    low, width, n_odd, start = low[pick], width[pick], n_odd[pick], start[:-1][pick]
    delta = np.zeros((len(low), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        raw = payload[start[rows][:, None] + np.arange(2 * LANE // 8 * w)]
        delta[rows] = _unpacked(raw, w)
    row = np.repeat(np.arange(len(low)), n_odd)
    if len(row):
        rank = np.arange(len(row)) - np.concatenate(([0], np.cumsum(n_odd)))[row]
        base = start[row] + 2 * LANE // 8 * width[row]
        raw = payload[(base + n_odd[row] + ID_BYTES * rank)[:, None] + np.arange(ID_BYTES)]
        delta[row, payload[base + rank]] = np.ascontiguousarray(raw).view("<u4").ravel()
    return (delta + low[:, None].astype(np.uint32)).ravel()[: max(0, n - first * BLOCK)]


def _packed(values: np.ndarray, w: int) -> np.ndarray:
    """Rows of 128 values in two lanes of ``w`` 64-bit words each, as bytes."""
    lanes = values.reshape(-1, 2, LANE).astype(np.uint64)
    out = np.zeros((len(values), 2, w), "<u8")
    for k in range(LANE):
        word, shift = divmod(k * w, 64)
        out[:, :, word] |= lanes[:, :, k] << np.uint64(shift)
        if shift + w > 64:
            out[:, :, word + 1] |= lanes[:, :, k] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1).view(np.uint8)


def _unpacked(raw: np.ndarray, w: int) -> np.ndarray:
    words = np.ascontiguousarray(raw).view("<u8").reshape(len(raw), 2, w)
    out = np.zeros((len(raw), 2, LANE), np.uint32)
    mask = np.uint64((1 << w) - 1)
    for k in range(LANE):
        word, shift = divmod(k * w, 64)
        value = words[:, :, word] >> np.uint64(shift)
        if shift + w > 64:
            value = value | words[:, :, word + 1] << np.uint64(64 - shift)
        out[:, :, k] = value & mask
    return out.reshape(len(raw), BLOCK)


def segments(docs: DataFrame, tokenizer: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """``(shard, segment, first_token, doc_ids, doc_tokens, data)``: all documents in ascending doc_id order.

    A shard is a range of doc_ids; ``first_token`` counts the shard's ids before the segment. Each document
    (``doc_id``, ``text``) is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Null doc_ids
    come first, repeated ones next to each other. A segment is closed once it has ``segment_ids`` ids; it
    never cuts a document. Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("first_token", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("doc_tokens", T.ArrayType(T.LongType())),
            T.StructField("data", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        names: list[pa.Array] = []
        held: list[bytes] = []

        def closed() -> pa.RecordBatch:
            nonlocal number, before
            ids = np.frombuffer(b"".join(held), "<u4")
            doc_ids = pa.concat_arrays(names)
            lists = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
            row = [
                pa.array([shard], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([before], pa.int64()),
                lists,
                pa.array([[len(x) // ID_BYTES for x in held]], pa.list_(pa.int64())),
                pa.array([encode(ids)], pa.binary()),
            ]
            number, before = number + 1, before + len(ids)
            names.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(row, schema.names)

        known, size = encoder(tokenizer), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                names.append(some.column(0))
                held += [x + end for x in known.encode(some.column(1).to_pylist())]
                size += sum(len(x) for x in held[-some.num_rows :]) // ID_BYTES
                if size >= segment_ids:
                    yield closed()
                    size = 0
        if held:
            yield closed()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(write, schema)


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document in ``files``, a written table of segments.

    ``start`` counts the ids of all documents before it; ``with_ids`` adds the ids as little-endian unsigned
    32-bit integers.
    """
    sums = files.groupBy("shard").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    bases = stored(sums.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    id_type = files.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [T.StructField("doc_id", id_type)]
        + [T.StructField(x, T.LongType()) for x in ("start", "n_tokens", "ids_crc32")]
        + [T.StructField("ids", T.BinaryType())] * with_ids
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = decode(batch.column(3)[k].as_py()).tobytes()
                n = np.array(batch.column(2)[k].as_py(), np.int64)
                ends = np.cumsum(n)
                parts = [raw[ID_BYTES * (e - c) : ID_BYTES * e] for c, e in zip(n.tolist(), ends.tolist(), strict=True)]
                columns = [
                    batch.column(1)[k].values,
                    pa.array(batch.column(0)[k].as_py() + ends - n),
                    pa.array(n),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                columns += [pa.array(parts, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    start = (F.col("base") + F.col("first_token")).alias("start")
    return files.join(bases, "shard").select(start, "doc_ids", "doc_tokens", "data").mapInArrow(unpack, schema)
