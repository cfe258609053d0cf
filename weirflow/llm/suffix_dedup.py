"""Removal of all byte strings of ``length`` bytes that start at more than one place in a corpus.

* Anchors. Of every ``length`` bytes the short gram with the smallest hash is an anchor, so two equal strings
  have the same anchor at the same place in them. Anchors are the only thing that all documents shuffle, one
  in about eighty-five bytes, with a hash of their context: the bytes that a string around them can reach.
* Equal contexts repeat every string in them, so they are counted and need no sorting; an anchor that occurs
  once repeats nothing.
* Halves. A string reaches half of the way or more to the left or to the right of its anchor. So contexts
  that share neither their left nor their right half with another one repeat nothing.
* Suffix arrays. What is left are edges of repeated passages: contexts that occur once, but share a half. They
  are dealt to shards by the half they share, with what strings around that half can reach, and each shard sorts the suffixes of its contexts by
  Larsson-Sadakane refinement in numpy: groups of equal ranks are split by the rank of the suffix that starts
  where the known prefix ends, and suffixes alone in their group are left out of later rounds. Prefixes are
  only refined to ``length`` bytes, where a group is a set of equal strings. Kasai's pass over common
  prefixes can't be vectorised and would add nothing: the ranks say which neighbours have ``length`` bytes in
  common.
* Hot halves. Equal strings have their anchor at the same place, so contexts of a half that very many share are dealt
  again by narrower ranges of that place, and by the bytes that all strings of such a range have in common. Contexts with
  all bytes of a range in common repeat every string in it, and only one of them goes on. So shards are as small as
  wanted, and nothing has to be merged across them: a merge by binary search would need each shard's suffixes in every
  other shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import stored, utf8, with_type

LENGTH = 200
GRAM = 32
SHARD_CONTEXTS = 4096
_BASE = 0x5851F42D4C957F2D
_CHUNK = 1 << 20
_SHARD_BYTES = 1 << 21
_RANKED_AT_ONCE = 1 << 16


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_KNOWN = [np.zeros((2, 0), np.uint64)]


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base and of its inverse modulo 2 ** 64."""
    if _KNOWN[0].shape[1] < n:
        _KNOWN[0] = np.stack([_powers_of(_BASE, 2 * n), _powers_of(pow(_BASE, -1, 1 << 64), 2 * n)])
    return _KNOWN[0][:, :n]


def _gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, the same wherever they stand."""
    powers, inverse = _powers(len(values))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((values + np.uint64(1)) * powers, dtype=np.uint64)))
    h = (sums[gram:] - sums[:-gram]) * inverse[: len(values) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """The least or greatest of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The places of the anchors of ``text``: those with the least hash in any ``length`` bytes."""
    width = length - gram + 1
    found = []
    for at in range(0, len(text) - length + 1, _CHUNK):
        values = np.frombuffer(text, np.uint8, min(len(text) - at, _CHUNK + length - 1), at).astype(np.uint64)
        h = _gram_hashes(values, gram)
        least = _sliding(np.minimum, h, width)
        edge = np.zeros(width - 1, np.uint64)
        chosen = _sliding(np.maximum, np.concatenate((edge, least, edge)), width) == h
        found.append(np.flatnonzero(chosen) + at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``(doc_id, text_hash, start, stop, anchor, context, left, right, n)`` for each anchor: the reach of its
    context, and hashes of the anchor, the context and its halves (0 for a half that the text is too short for).
    ``start`` is always as far before the anchor, so it may lie before the text.

    A context that a text has several times is one row with its number; where those occurrences lie is told
    by rows without an anchor, merged.
    """
    longs = [T.StructField(x, T.LongType()) for x in ("start", "stop", "anchor", "context", "left", "right", "n")]
    schema = T.StructType([with_type(docs, "doc_id"), T.StructField("text_hash", T.IntegerType()), *longs])
    reach = length - gram
    half = reach // 2

    def of(text: bytes) -> np.ndarray:
        places = anchors(text, length, gram)
        start, stop = np.maximum(places - reach, 0), np.minimum(places + length, len(text))
        digest = xxhash.xxh64_intdigest
        gram_hash = np.array([digest(text[p : p + gram]) for p in places.tolist()], np.uint64)
        around = [digest(text[a:b], p - a) for p, a, b in zip(places.tolist(), start.tolist(), stop.tolist(), strict=True)]
        left = [digest(text[p - half : p + gram], 1) if p >= half else 0 for p in places.tolist()]
        right = [digest(text[p : p + gram + half], 2) if p + gram + half <= len(text) else 0 for p in places.tolist()]
        hashes = [np.array(h, np.uint64).view(np.int64) for h in (gram_hash, around, left, right)]
        rows = np.column_stack([places - reach, stop, *hashes])
        _, first, which, n = np.unique(rows[:, 3], return_index=True, return_inverse=True, return_counts=True)
        out = [np.column_stack([rows[first], n])]
        if len(first) < len(rows):
            again = n[which.ravel()] > 1
            spans = _merged(start[again], stop[again])
            out.append(np.column_stack([spans, np.zeros((len(spans), 5), np.int64)]))
        return np.concatenate(out)

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "text")
            rows, owner = [], []
            for k, text in enumerate(texts):
                if text is not None and len(text) >= length:
                    rows.append(of(text))
                    owner.append(np.full(len(rows[-1]), k))
            if rows:
                table, row = np.concatenate(rows), pa.array(np.concatenate(owner))
                columns = [pa.array(table[:, k]) for k in range(7)]
                columns[2] = pa.array(table[:, 2], mask=table[:, 6] == 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(2).take(row), *columns], schema.names)

    return docs.select("doc_id", "text", F.hash("text").alias("text_hash")).mapInArrow(list_anchors, schema)


def _merged(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The union of ranges as maximal ranges in order."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.concatenate(([True], start[1:] > reach[:-1]))
    last = np.concatenate((first[1:], [True]))
    return np.column_stack([start[first], reach[last]])


def repeated_suffixes(
    contexts: list[bytes], text: np.ndarray, start: np.ndarray, weight: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(context, place in it, repeated, group)`` for each suffix of at least ``length`` bytes.

    A suffix is repeated if its first ``length`` bytes occur at another place: in a context of another text,
    at another place of the same one, or in a context of ``weight`` above 1. ``text`` numbers the texts,
    ``start`` is where a context starts in its text. Suffixes with the same first ``length`` bytes have the same
    ``group``, in all calls. Suffixes are refined by prefix doubling, with hashes of 64 bits as ranks, so that only
    the last round has to be sorted; the array is in the order of these ranks, with equal strings side by side.
    """
    size = np.array([len(c) for c in contexts], np.int64)
    count = np.maximum(size - length + 1, 0)
    owner = np.repeat(np.arange(len(contexts)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    rank = _prefix_ranks(np.frombuffer(b"".join(contexts), np.uint8), length)[(np.cumsum(size) - size)[owner] + place]
    repeated = np.zeros(len(rank), bool)
    if len(rank):
        array = np.argsort(rank)
        ranks = rank[array]
        turns = np.concatenate(([True], ranks[1:] != ranks[:-1], [True]))
        array = array[~(turns[1:] & turns[:-1])]  # without those that are alone with their rank
    if len(rank) and len(array):
        # Groups of equal strings; a place that several contexts show is one place.
        ranks, who = rank[array], owner[array]
        where = (text[who] << np.int64(40)) | (start[who] + place[array])
        first = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
        several = np.minimum.reduceat(where, first) != np.maximum.reduceat(where, first)
        heavy = np.maximum.reduceat(weight[who], first) > 1
        repeated[array] = np.repeat(several | heavy, np.diff(np.concatenate((first, [len(array)]))))
    return owner, place, repeated, rank.view(np.int64)


def _prefix_ranks(values: np.ndarray, length: int) -> np.ndarray:
    """A rank of the ``length`` bytes from each place on: of the first 8, then of twice as many in each round."""
    out = np.zeros(max(0, len(values) - length + 1), np.uint64)
    for at in range(0, len(out), _RANKED_AT_ONCE):
        some = values[at : at + _RANKED_AT_ONCE + length - 1]
        depth = min(8, length)
        rank = np.zeros(len(some) - depth + 1, np.uint64)
        for k in range(depth):
            rank = rank << np.uint64(8) | some[k : k + len(rank)]
        while depth < length:
            step = min(depth, length - depth)
            further = rank[step:]
            rank = rank[: len(further)] * np.uint64(0x9E3779B97F4A7C15)
            rank ^= rank >> np.uint64(31)
            rank *= np.uint64(0xBF58476D1CE4E5B9)
            rank ^= rank >> np.uint64(27)
            rank += further
            rank *= np.uint64(0x94D049BB133111EB)
            rank ^= rank >> np.uint64(32)
            depth += step
        out[at : at + len(rank)] = rank
    return out


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """``(doc_id, text_hash, start, stop)``: byte ranges whose union is all that repeated strings cover."""
    listed = stored(_occurrences(docs, length, gram))
    counts = listed.where("anchor is not null").groupBy("anchor").agg(F.sum("n").alias("total"))
    busy = stored(listed.join(counts.where("total > 1").select("anchor"), "anchor", "left_semi"))
    owner = F.struct("doc_id", "text_hash", "start", "stop")
    by_context = busy.groupBy("anchor", "context").agg(
        F.sum("n").alias("n"), F.min(owner).alias("one"), F.min("left").alias("left"), F.min("right").alias("right")
    )
    by_context = stored(by_context)
    equal = by_context.where("n > 1").select("anchor", "context")
    in_text = F.greatest("start", F.lit(0)).alias("start")
    whole = busy.join(equal, ["anchor", "context"], "left_semi").select("doc_id", "text_hash", in_text, "stop")
    halves = by_context.select("anchor", "context", "n", F.posexplode(F.array("left", "right")).alias("side", "shard")).where("shard != 0")
    shared = halves.groupBy("shard").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where("contexts > 1 and least = 1")
    edge = halves.join(shared, "shard").select("anchor", "context", "side", "shard", (F.col("contexts") > shard_contexts).alias("hot"))
    # A string's anchor is ``low`` to ``high`` bytes behind its start: in the left half or in the right one.
    reach = length - gram
    low, high = F.when(F.col("side") == 0, reach // 2).otherwise(0), F.when(F.col("side") == 0, reach).otherwise(reach // 2)
    place = F.col("one.start") + reach
    edges = (
        by_context.join(edge, ["anchor", "context"])
        .select("one", "n", "anchor", "shard", "hot", place.alias("place"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))
        .withColumn("start", F.greatest(F.col("place") - F.col("high"), F.lit(0)))
        .withColumn("stop", F.least(F.col("place") - F.col("low") + length, "one.stop"))
        .groupBy("one.doc_id", "one.text_hash")
        .agg(F.collect_list(F.struct("start", "stop", "anchor", "n", "shard", "hot", (F.col("place") - F.col("start")).alias("at"), "low", "high")).alias("edges"))
    )
    contexts = stored(_cut(docs, edges))
    met, few = _narrowed(contexts.where("hot").drop("hot", "stop"), length, shard_contexts)
    names = ["doc_id", "text_hash", "start", "stop", "anchor", "n", "shard", "bytes"]
    found = _sorted_shards(contexts.where("not hot").select(names).union(few.select(names)), length)
    ranges = ["doc_id", "text_hash", "start", "stop"]
    return listed.where("anchor is null").select(ranges).union(whole).union(met.select(ranges)).union(found)


def _cut(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """The ``edges`` of each text as rows, with their ``bytes``."""
    cut = F.expr("transform(edges, e -> named_struct('e', e, 'bytes', substring(_bytes, cast(e.start + 1 as int), cast(e.stop - e.start as int))))")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.hash("d.text") == F.col("s.text_hash"))
    return (
        docs.select("doc_id", "text").alias("d")
        .join(edges.alias("s"), same)
        .select("s.doc_id", "s.text_hash", "edges", F.col("d.text").cast("binary").alias("_bytes"))
        .select("doc_id", "text_hash", F.explode(cut).alias("c"))
        .select("doc_id", "text_hash", "c.e.*", "c.bytes")
    )


def _narrowed(hot: DataFrame, length: int, shard_contexts: int) -> tuple[DataFrame, DataFrame]:
    """Ranges that contexts of hot shards have in common, and the contexts in shards small enough to be sorted.

    Rows hold ``bytes`` from ``start`` on, the anchor ``at`` a place in them, and stand for the strings whose anchor is
    ``low`` to ``high`` bytes behind their start. All rows of a ``shard`` have the bytes that all these strings show.
    """
    columns = ["doc_id", "text_hash", "start", "anchor", "n", "shard", "at", "low", "high", "bytes"]
    stop = (F.col("start") + F.length("bytes")).alias("stop")
    met = few = None
    while True:
        hot = hot.select(columns).withColumn("around", F.xxhash64("bytes"))
        equal = ["shard", "low", "at", "around"]
        rest = [c for c in columns if c not in equal]
        groups = stored(hot.groupBy(equal).agg(F.sum("n").alias("total"), F.min(F.struct(rest)).alias("one")))
        several = groups.where("total > 1").select(equal)
        all_met = hot.where("n = 1").join(several, equal, "left_semi").select("doc_id", "text_hash", "start", stop)
        one = groups.select("shard", "low", "at", "total", "one.*").withColumn("n", F.least("total", F.lit(2).cast("bigint")))
        crowds = one.groupBy("shard").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where("contexts > 1 and least = 1")
        left = stored(one.join(crowds.select("shard", "contexts"), "shard").select(*columns, "contexts"))
        small = left.where(F.col("contexts") <= shard_contexts).select(*columns, stop)
        met, few = (all_met, small) if met is None else (met.union(all_met), few.union(small))
        large = left.where(F.col("contexts") > shard_contexts)
        if large.isEmpty():
            return met, few
        hot = stored(_split(large, length))


def _split(rows: DataFrame, length: int) -> DataFrame:
    """The rows for each half of their range of places, dealt by the bytes that all strings of it have in common."""
    parts = F.expr("array(named_struct('l', low, 'h', (low + high) div 2), named_struct('l', (low + high) div 2 + 1, 'h', high))")
    size = F.length("bytes")
    begin, end = F.greatest(F.col("at") - F.col("p.h"), F.lit(0)), F.least(F.col("at") - F.col("p.l") + length, size)
    core = F.substring("bytes", (F.col("at") - F.col("p.l") + 1).cast("int"), (F.col("p.l") - F.col("p.h") + length).cast("int"))
    return (
        rows.withColumn("p", F.explode(parts))
        .where((F.col("at") >= F.col("p.l")) & (F.col("at") - F.col("p.h") + length <= size))
        .select(
            "doc_id", "text_hash", (F.col("start") + begin).alias("start"), "anchor", "n", F.xxhash64("p.l", "p.h", core).alias("shard"),
            (F.col("at") - begin).alias("at"), F.col("p.l").alias("low"), F.col("p.h").alias("high"),
            F.substring("bytes", (begin + 1).cast("int"), (end - begin).cast("int")).alias("bytes"),
        )
    )


def _sorted_shards(contexts: DataFrame, length: int) -> DataFrame:
    """The ranges that repeat by the shards' suffix arrays."""
    schema = T.StructType([contexts.schema[x] for x in ("doc_id", "text_hash", "start", "stop")])

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            keys = batch.column(6).to_numpy()
            turns = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                key = keys[a] if b > a else last
                if key != last and size >= _SHARD_BYTES:
                    yield _shard(held, schema, length)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(np.sum(held[-1].column(3).to_numpy() - held[-1].column(2).to_numpy()))
                last = key
        if held:
            yield _shard(held, schema, length)

    return contexts.repartition("shard").sortWithinPartitions("shard").mapInArrow(sort_shards, schema)


def _shard(held: list[pa.RecordBatch], schema: T.StructType, length: int) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    start, n = rows.column(2).to_numpy(), rows.column(5).to_numpy()
    contexts = rows.column(7).to_pylist()
    named = pa.StructArray.from_arrays([rows.column(0), rows.column(1)], ["a", "b"])
    text = np.array(_numbered(named.to_pylist()), np.int64)
    owner, place, repeated, _ = repeated_suffixes(contexts, text, start, n, length)
    # Runs of repeated suffixes of one context cover one range.
    hit = repeated & (n[owner] == 1)
    joined = hit[1:] & hit[:-1] & (owner[1:] == owner[:-1]) & (place[1:] == place[:-1] + 1)
    opens = np.flatnonzero(hit & ~np.concatenate(([False], joined)))
    closes = np.flatnonzero(hit & ~np.concatenate((joined, [False])))
    base, take = start[owner], pa.array(owner[opens])
    columns = [rows.column(0).take(take), rows.column(1).take(take), pa.array(base[opens] + place[opens]), pa.array(base[closes] + place[closes] + length)]
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _numbered(values: list[dict]) -> list[int]:
    seen: dict[tuple, int] = {}
    return [seen.setdefault((v["a"], v["b"]), len(seen)) for v in values]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS, with_bytes: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for each row of ``docs`` (``doc_id``, ``text``).

    Texts are judged as UTF-8 bytes; every byte of a string of ``length`` bytes that also starts anywhere else
    goes, in all its places. ``with_bytes`` adds ``kept``, the bytes that are left. A null text is empty; a
    text shorter than ``length`` loses nothing. Repeated rows are different places: they lose all of a text
    that is long enough. Other columns are not read.
    """
    ranges = repeated_ranges(docs, length, gram, shard_contexts)
    per_text = ranges.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    hashed = docs.select("doc_id", "text", F.hash("text").alias("text_hash")).alias("d")
    longs = [T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([with_type(docs, "doc_id"), *longs, T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept", T.BinaryType())] * with_bytes)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, digests, left = [], [], []
            for text, spans in zip(utf8(batch, "text"), batch.column(2), strict=True):
                text, cut = text or b"", np.zeros((0, 2), np.int64)
                if spans.is_valid:
                    cut = _merged(spans.values.field(0).to_numpy(), spans.values.field(1).to_numpy())
                edges = [0, *cut.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                numbers.append((len(text), len(text) - len(kept), len(cut)))
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept)
            columns = [pa.array([x[k] for x in numbers], pa.int64()) for k in range(3)] + [pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns] + [pa.array(left, pa.binary())] * with_bytes, schema.names)

    return hashed.join(per_text.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans").mapInArrow(remove, schema)
