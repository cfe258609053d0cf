"""Mixture-controlled packing of documents into fixed windows of tokens by deficit round-robin.

Each source is a queue of its documents' token ids, served in quanta. A queue's deficit grows by its share of
all tokens with each token that is packed, and its next quantum is due when the deficit reaches half a quantum.
Quanta are served in the order in which they fall due, so what a queue is owed or has had too much is carried
from window to window over the whole run, and also the rarest queue is served at its even places.

A quantum falls due when as great a part of the run is over as its queue has tokens before the quantum's
middle, whatever the other queues do. So any task can count the quanta before any window without a pass over
the windows before it, and plans only the blocks of windows that its own documents lie in.

Documents are encoded once, into a written table with each document's place in its queue within its
partition; sums per partition and queue give the places in the whole queue.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import release, stored, with_type
from weirflow.llm.tokens import GENERATION_BYTES, ID_BYTES, encoder

LENGTH = 2048
QUANTUM = 128
CYCLE = 64
KNOWN_BLOCKS = 64
MAX_QUEUES = 512
BROADCAST_ROWS = 100_000


@dataclass
class Phase:
    """A block of windows. ``served[w, k]``: tokens of queue k in the block's windows before w."""

    first_window: int
    before: np.ndarray
    served: np.ndarray
    repeats: int = 1


class Plan(Sequence):
    """The phases that serve queues of ``totals`` tokens whole, in blocks of ``cycle`` windows, each planned when asked for."""

    def __init__(self, totals: np.ndarray, length: int, quantum: int, cycle: int):
        self.totals, self.length, self.quantum, self.cycle = totals.astype(np.int64), length, quantum, cycle
        self.quanta = -(-self.totals // quantum)
        self.tokens = int(self.totals.sum())
        self.windows = -(-self.tokens // length)
        self._known: dict[int, Phase] = {}

    def __len__(self) -> int:
        return -(-self.windows // self.cycle)

    def __getitem__(self, n):
        if isinstance(n, slice):
            return [self[k] for k in range(*n.indices(len(self)))]
        if not 0 <= n < len(self):
            raise IndexError(n)
        if n not in self._known:
            if len(self._known) >= KNOWN_BLOCKS:
                del self._known[next(iter(self._known))]
            self._known[n] = self._block(n)
        return self._known[n]

    def holding(self, queue: int, at: int) -> int:
        """The number of the phase that serves position ``at`` of ``queue``."""
        n = min(int(at / int(self.totals[queue]) * self.windows) // self.cycle, len(self) - 1)
        while at < self[n].before[queue]:
            n -= 1
        while at >= self[n].before[queue] + self[n].served[-1, queue]:
            n += 1
        return n

    def _due(self, nth: np.ndarray, queue: np.ndarray) -> np.ndarray:
        at, total = nth * self.quantum, self.totals[queue]
        return (at + np.minimum(at + self.quantum, total)) / (2 * np.maximum(total, 1))

    def _before(self, time: float) -> np.ndarray:
        """How many quanta of each queue are due before ``time``."""
        each = np.arange(len(self.quanta))
        n = np.clip(np.floor(time * self.totals / self.quantum + 0.5).astype(np.int64), 0, self.quanta)
        n -= (n > 0) & (self._due(n - 1, each) >= time)
        return n + ((n < self.quanta) & (self._due(n, each) < time))

    def _block(self, n: int) -> Phase:
        size = self.cycle * self.length
        start, stop = n * size, min((n + 1) * size, self.tokens)
        bounds = np.minimum(np.arange(start, stop + self.length, self.length), stop)
        # Of what is due before a time, each queue has less than two quanta more or less than its share.
        margin = 2 * self.quantum * len(self.totals)
        low, high = self._before((start - margin) / self.tokens), self._before((stop + margin) / self.tokens)
        owner = np.repeat(np.arange(len(low)), high - low)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - high, high - low)
        order = np.lexsort((owner, self._due(nth, owner)))
        owner, nth = owner[order], nth[order]
        sizes = np.minimum(self.quantum, self.totals[owner] - nth * self.quantum)
        earlier = np.minimum(low * self.quantum, self.totals)
        ends = int(earlier.sum()) + np.cumsum(sizes)
        served = np.zeros((len(bounds) + 1, len(low)), np.int64)
        np.add.at(served, (np.searchsorted(bounds, ends), owner), sizes)
        served = earlier + np.cumsum(served[:-1], axis=0)
        cut = np.searchsorted(ends, bounds, side="right")
        some = np.flatnonzero(cut < len(ends))
        cut = cut[some]
        served[some, owner[cut]] += bounds[some] - ends[cut] + sizes[cut]
        return Phase(n * self.cycle, served[0], served - served[0])


def plan(totals: np.ndarray, length: int = LENGTH, quantum: int = QUANTUM, cycle: int = CYCLE) -> Plan:
    """Phases that serve queues of ``totals`` tokens whole; every window but the last is full."""
    return Plan(totals, length, quantum, cycle)


def pieces(phases: Plan, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int, int]]:
    """``(position, length, window, offset)`` of the pieces of ``n`` tokens from ``start`` on in a queue."""
    for some in _pieces(phases, queue, np.array([start]), np.array([start + n])) if n else ():
        yield from zip(*(column.tolist() for column in some[1:]), strict=True)


def _pieces(phases: Plan, queue: int, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``(document, position, length, window, offset)`` of the pieces of a queue's documents, a phase at a time.

    Documents lie from ``start`` to ``end``, in order and none in another's place.
    """
    done = k = 0
    while done < len(start):
        if not k or start[done] >= upto:  # documents between may lie elsewhere
            k = phases.holding(queue, int(start[done]))
        phase = phases[k]
        edges = phase.before[queue] + phase.served[:, queue]
        upto = edges[-1]
        last = int(start.searchsorted(upto))
        points = np.concatenate((edges, start[done:last], end[done:last]))
        points = np.unique(points[(points >= max(start[done], edges[0])) & (points <= upto)])
        lead = phase.served[1:, :queue].sum(axis=1) - phase.served[:-1, :queue].sum(axis=1) - edges[:-1]
        at = points[:-1]
        owner = start.searchsorted(at, "right") - 1
        some = np.flatnonzero(at < end[owner])
        at, window = at[some], edges.searchsorted(at[some], "right") - 1
        yield owner[some], at, points[some + 1] - at, phase.first_window + window, lead[window] + at
        done, k = int(end.searchsorted(upto, "right")), k + 1


def encoded(
    docs: DataFrame, path: str, end_id: int, queue_of: dict | None, queues: int, word_bytes: int = GENERATION_BYTES
) -> DataFrame:
    """``(doc_id, part, queue, at, n, ids)``: each document's ids and place in its queue within its partition.

    ``queue_of`` maps sources to queues; sources that it lacks are dealt to ``queues`` queues by a hash.
    """
    schema = T.StructType(
        [
            with_type(docs, "doc_id"),
            T.StructField("part", T.IntegerType()),
            T.StructField("queue", T.IntegerType()),
            T.StructField("at", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, filled = TaskContext.get().partitionId(), encoder(path, word_bytes), [0] * queues
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                ids = [x + end for x in known.encode(some.column(1).to_pylist())]
                owner = [_queue(s, queue_of, queues) for s in some.column(2).to_pylist()]
                at, n = [], [len(x) // ID_BYTES for x in ids]
                for queue, count in zip(owner, n, strict=True):
                    at.append(filled[queue])
                    filled[queue] += count
                columns = [
                    some.column(0),
                    pa.array([part] * len(n), pa.int32()),
                    pa.array(owner, pa.int32()),
                    pa.array(at, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", "text", source.alias("source")).mapInArrow(encode, schema)


def _queue(source: str | None, queue_of: dict | None, queues: int) -> int:
    if queue_of is not None:
        return queue_of[source]
    return zlib.crc32((source or "").encode()) % queues


def _queues(docs: DataFrame, max_queues: int) -> tuple[dict | None, int]:
    """A queue for each source in order of name, or ``max_queues`` hashed ones if there are more sources."""
    if "source" not in docs.columns:
        return {None: 0}, 1
    rows = docs.select(F.col("source").cast("string")).distinct().limit(max_queues + 1).collect()
    if len(rows) > max_queues:
        return None, max_queues
    names = sorted((r[0] for r in rows), key=lambda s: (s is not None, s))
    return {s: k for k, s in enumerate(names)} or {None: 0}, max(1, len(names))


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, quantum: int = QUANTUM,
    max_queues: int = MAX_QUEUES, with_ids: bool = False, word_bytes: int = GENERATION_BYTES,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue)``, one row per piece.

    Every document (``doc_id``, ``text``, ``source``) is its ids and ``end_id``; a null or empty text is
    ``end_id`` alone. Sequences hold ``length`` ids, only the last one may hold less. ``with_ids`` adds the
    piece's ids as little-endian unsigned 32-bit integers. Targets are the queues' shares of all tokens, so
    that every window has the mixture of the corpus. Null sources are a queue of their own; beyond
    ``max_queues`` sources, queues hold several sources each. Repeated rows are packed as often as they
    occur. A Python worker keeps words of two generations of ``word_bytes`` while it encodes. Other columns are
    not read.
    """
    queue_of, queues = _queues(docs, max_queues)
    tokens = stored(encoded(docs, tokenizer, end_id, queue_of, queues, word_bytes))
    sums = stored(tokens.groupBy("part", "queue").agg(F.sum("n").alias("n")))
    totals = np.zeros(queues, np.int64)
    for row in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect():  # one row per queue
        totals[row["queue"]] = row["n"]
    phases = plan(totals, length, quantum)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    if sums.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, ["part", "queue"]).select("doc_id", "queue", (F.col("base") + F.col("at")).alias("at"), "n", "ids")

    @F.arrow_udf("array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>")
    def cut(queue: pa.Array, at: pa.Array, n: pa.Array) -> pa.Array:
        return _cut(phases, queue.to_numpy(), at.to_numpy(), n.to_numpy())

    def with_part(p: Column) -> Column:
        part = F.col("ids").substr((p["start"] * ID_BYTES + 1).cast("int"), (p["length"] * ID_BYTES).cast("int"))
        columns = [p[x].alias(x) for x in ("start", "length", "sequence_id", "offset")] + [F.crc32(part).alias("ids_crc32")]
        return F.struct(*columns, *[part.alias("ids")] * with_ids)

    cuts = placed.withColumn("pieces", cut("queue", "at", "n")).select("doc_id", "n", "queue", F.explode(F.transform("pieces", with_part)).alias("p"))
    names = ["p.start", "p.length", "p.ids_crc32", F.col("n").alias("doc_tokens"), "p.sequence_id", "p.offset", "queue"]
    return cuts.select("doc_id", *names, *["p.ids"] * with_ids)


def _cut(phases: Plan, queue: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.Array:
    """A list for each document: its pieces, without their ids. ``start`` counts from the document's first token.

    What the process has kept for encoding is let go.
    """
    release()
    found = [np.zeros((5, 0), np.int64)]
    for one in np.unique(queue).tolist():
        rows = np.flatnonzero(queue == one)
        rows = rows[np.argsort(at[rows])]
        for owner, *columns in _pieces(phases, one, at[rows], at[rows] + n[rows]):
            found.append(np.stack([rows[owner], *columns]))
    row, position, *others = np.concatenate(found, axis=1)
    order = np.lexsort((position, row))
    ends = np.searchsorted(row[order], np.arange(len(n) + 1)).astype(np.int32)
    columns = [pa.array(column[order]) for column in (position - at[row], *others)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["start", "length", "sequence_id", "offset"]))
