"""Removal of repeated passages by MinHash banding of paragraphs.

A paragraph is a line, cut further where a line is long: before every word whose three-word hash is the
least within ``reach`` words on both sides in its line. Such places move with the text, so a passage is cut
alike wherever it stands, also in the middle of a line. Paragraphs of fewer than ``MIN_WORDS`` words are not
compared.

* Bands. Two paragraphs share a MinHash with the chance of their Jaccard similarity over five-word shingles.
  First all paragraphs meet on four single MinHashes: pairs at 0.8 meet but for 0.2 %, and most paragraphs
  meet nobody, because unrelated texts share next to no five-word shingles. Those that met somebody meet
  again on ``BANDS`` bands of ``ROWS`` MinHashes: pairs at 0.8 meet but for 0.2 %, pairs at 0.3 hardly ever.
* Of the paragraphs that meet on a band, each is compared with one of them by exact Jaccard, the same for as many
  bands as can be. What is left are pairs of paragraphs of different classes on a band. Similar ones must have so many
  shingles in common, by their two sizes, that the first of these are among the first few of both, rarest first. Each
  choice of such shingles is a key, for each size that a similar paragraph can have, so similar ones meet on a key and no
  link on a band is missed. On a key, each paragraph is compared with one of the other size. Keys that still have several
  classes are keyed again, now rarest first among those of the key: paragraphs with words of their own drop out. Only what
  is left after ``ROUNDS`` rounds is compared in pairs.
* Components of similar paragraphs are classes, and equal paragraphs are one from the start. The first
  occurrence of a class stays. What goes are passages: neighbouring repeated paragraphs that have
  ``passage_words`` words or more together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import components, stored, utf8, with_type
from weirflow.llm.contamination import _TO_WORDS
from weirflow.llm.suffix_dedup import _sliding

SIMILARITY = 0.8
SHINGLE = 5
MIN_WORDS = 8
REACH = 6
PASSAGE_WORDS = 14
GAP_WORDS = 8
ROWS, BANDS = 6, 20
ROUNDS = 2
#: At most so many keys of more than one shingle for each size of partners.
KEYS = 16
_FIRST = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    return h ^ h >> np.uint64(29)


class _WordHashes(dict):
    """Hashes of words, kept for the words that a process has met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _WordHashes()


def _words(plain: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and stop in a text whose other bytes are spaces, and a hash of each."""
    inside = np.zeros(len(plain) + 2, bool)
    inside[1:-1] = np.frombuffer(plain, np.uint8) != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2], np.array(list(map(_HASHES.__getitem__, plain.split())), np.uint64)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x2545F4914F6CDD1D) + words[k : k + len(out)])
    return out


def paragraphs(text: bytes, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """``(rows of first word, words, first byte, end byte, MinHashes), plain text``; only paragraphs of MIN_WORDS words."""
    plain = text.translate(_TO_WORDS)
    start, stop, words = _words(plain)
    empty = np.zeros((0, 4 + len(_FIRST)), np.int64), plain
    if len(words) < MIN_WORDS:
        return empty
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A)
    line = np.searchsorted(breaks, start)
    # Three-word hashes at their places, lines kept apart by more than the reach; the last two words of a line have none.
    rank = np.concatenate((_grams(words, 3), np.zeros(2, np.uint64))) >> np.uint64(1)
    same_line = np.concatenate((line[2:] == line[:-2], [False, False]))
    place = np.arange(len(words)) + (reach + 1) * line
    worst = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full(int(place[-1]) + 1 + 2 * reach, worst)
    padded[place + reach] = np.where(same_line, rank, worst)
    least = _sliding(np.minimum, padded, 2 * reach + 1)[place]
    cut = (same_line & (rank == least)) | np.concatenate(([True], line[1:] != line[:-1]))
    first = np.flatnonzero(cut)
    end = np.concatenate((first[1:], [len(words)]))
    long = end - first >= MIN_WORDS
    first, end = first[long], end[long]
    if not len(first):
        return empty
    shingles = _grams(words, SHINGLE)
    spans = np.column_stack([first, end - SHINGLE + 1]).ravel()
    spans = spans[:-1] if spans[-1] >= len(shingles) else spans
    bands = [np.minimum.reduceat(_mixed(shingles ^ b), spans)[::2] for b in _FIRST]
    columns = [first, end - first, start[first], stop[end - 1], *[b.view(np.int64) for b in bands]]
    return np.column_stack(columns), plain


def _listed(docs: DataFrame) -> DataFrame:
    """A row per paragraph: its place, its ``id`` (a hash of its words) and its MinHashes."""
    places = [with_type(docs, "doc_id"), T.StructField("text_hash", T.IntegerType())]
    places += [T.StructField(x, T.LongType()) for x in ("id", "first", "words", "start", "stop")]
    schema = T.StructType(places + [T.StructField("bands", T.ArrayType(T.LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tables, owner = [], [], []
            for k, text in enumerate(utf8(batch, "text")):
                rows, plain = paragraphs(text) if text else (np.zeros((0, 4 + len(_FIRST)), np.int64), b"")
                ids += [xxhash.xxh64_intdigest(plain[a:b]) for a, b in rows[:, 2:4].tolist()]
                tables.append(rows)
                owner.append(np.full(len(rows), k))
            table, who = np.concatenate(tables), np.concatenate(owner)
            named = pa.array(np.array(ids, np.uint64).view(np.int64))
            bands = np.ascontiguousarray(table[:, 4:])
            lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, len(_FIRST), dtype=np.int32), pa.array(bands.ravel()))
            take = pa.array(who)
            columns = [batch.column(0).take(take), batch.column(2).take(take), named, *[pa.array(table[:, k]) for k in range(4)], lists]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text", F.hash("text").alias("text_hash")).mapInArrow(cut, schema)


def _meeting(units: DataFrame) -> DataFrame:
    """The ids of all paragraphs that meet a different one on a single MinHash."""
    keyed = units.select("id", F.posexplode("bands").alias("k", "h")).select("id", F.xxhash64("h", "k").alias("band"))
    group = Window.partitionBy("band")
    both = keyed.select("id", F.min("id").over(group).alias("low"), F.max("id").over(group).alias("high"))
    return stored(both.where("low != high").select("id").distinct())


_ROW_SEEDS = _mixed(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64))


def _banded(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bands of each set of shingles (sets start at ``starts``, none is empty), each a hash of its MinHashes."""
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(starts), 1))
    for k, seed in enumerate(_ROW_SEEDS):
        least = np.minimum.reduceat(_mixed(shingles ^ seed), starts)
        band = out[:, k // ROWS]
        band[:] = _mixed(band * np.uint64(0x2545F4914F6CDD1D) + least)
    return out.view(np.int64)


def _shingle_sets(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each piece in order, side by side, and where each piece's start."""
    words = [x.translate(_TO_WORDS).split() for x in pieces]
    owner = np.repeat(np.arange(len(words)), list(map(len, words)))
    shingles = _grams(np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(words)), np.uint64, len(owner)), SHINGLE)
    inside = owner[: len(shingles)] == owner[SHINGLE - 1 :]
    shingles, owner = shingles[inside], owner[: len(shingles)][inside]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(len(words)))


def _contents(docs: DataFrame, units: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(id, shingles, bands)``: hashes of the five-word shingles of the wanted paragraphs, and their bands."""
    one = units.join(wanted, "id", "left_semi").groupBy("id").agg(F.min(F.struct("doc_id", "text_hash", "start", "stop")).alias("o"))
    per_text = one.groupBy("o.doc_id", "o.text_hash").agg(F.collect_list(F.struct("id", "o.start", "o.stop")).alias("spans"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.hash("d.text") == F.col("s.text_hash"))
    cut = F.expr("transform(spans, e -> named_struct('id', e.id, 'bytes', substring(_bytes, cast(e.start + 1 as int), cast(e.stop - e.start as int))))")
    cuts = (
        docs.select("doc_id", "text").alias("d")
        .join(per_text.alias("s"), same)
        .select("spans", F.col("d.text").cast("binary").alias("_bytes"))
        .select(F.explode(cut).alias("c"))
        .select("c.id", "c.bytes")
    )

    @F.arrow_udf("struct<shingles:array<bigint>,bands:array<bigint>>")
    def signed(pieces: pa.Array) -> pa.Array:
        flat, starts = _shingle_sets(pieces.to_pylist())
        bands = _banded(flat, starts).ravel()
        lists = [
            pa.ListArray.from_arrays(np.append(starts, len(flat)).astype(np.int32), pa.array(flat.view(np.int64))),
            pa.ListArray.from_arrays(np.arange(0, len(bands) + 1, BANDS, dtype=np.int32), pa.array(bands)),
        ]
        return pa.StructArray.from_arrays(lists, ["shingles", "bands"])

    found = cuts.select("id", signed("bytes").alias("s")).dropDuplicates(["id"])
    return found.select("id", "s.shingles", "s.bands")


def _similar(docs: DataFrame, units: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: similar paragraphs that connect each class."""
    return _linked(stored(_contents(docs, units, _meeting(units))), similarity)


def _verified(pairs: DataFrame, contents: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: the ``pairs`` (``id``, ``centre``) whose exact Jaccard similarity is high enough."""
    ours = contents.select("id", "shingles")
    theirs = contents.select(F.col("id").alias("centre"), F.col("shingles").alias("others"))
    common = F.size(F.array_intersect("shingles", "others"))
    jaccard = common / (F.size("shingles") + F.size("others") - common)
    similar = pairs.join(ours, "id").join(theirs, "centre").where(jaccard >= similarity)
    return stored(similar.select(F.col("id").alias("a"), F.col("centre").alias("b")))


def _of_several_classes(rows: DataFrame, labels: DataFrame, key: str, such: Column | bool = True) -> DataFrame:
    """The ``rows`` with their ``class``, where the ``key`` has more than one and ``such`` rows."""
    rows = rows.join(labels, rows["id"] == labels["node"], "left").withColumn("class", F.coalesce("label", "id")).drop("node", "label")
    several = (F.min("class") != F.max("class")) & F.lit(such)
    return stored(rows.join(rows.groupBy(key).agg(several.alias("several")).where("several"), key, "left_semi"))


def _bucket(size: int) -> int:
    """The least of the sizes that are taken together with ``size``: exact below 32, within a sixteenth above."""
    width = 1 << max(0, size.bit_length() - 5)
    return size // width * width


def _partners(size: int, similarity: float) -> list[int]:
    """The buckets of sizes that a set similar to one of ``size`` can have."""
    found, most = [_bucket(max(1, math.ceil(size * similarity - 1e-9)))], size / similarity + 1e-9
    while (after := found[-1] + (1 << max(0, found[-1].bit_length() - 5))) <= most:
        found.append(after)
    return found


def _in_common(size: int, other: int, similarity: float) -> int:
    """How many shingles similar sets of ``size`` and of ``other`` or more have in common at least."""
    return max(1, math.ceil((size + other) * similarity / (1 + similarity) - 1e-9))


@cache
def _taken(low: int, high: int, similarity: float) -> int:
    """How many shingles a key takes between two buckets of sizes: as many as leave ``KEYS`` keys or fewer, at least one."""
    common = _in_common(low, high, similarity)
    taken = 1
    while taken < common and math.comb(high - common + taken + 1, taken + 1) <= KEYS:
        taken += 1
    return taken


def _keys(rare: list[int], lone: int, size: int, partner: int, key: int, similarity: float) -> Iterator[int]:
    """The keys of a set for similar ones of a bucket: each choice of shingles that can be the first they have in common.

    ``rare`` are its shingles that others have too, in the order that all have; ``lone`` go before them.
    """
    low, high = sorted((_bucket(size), partner))
    common, taken = _in_common(size, partner, similarity), _taken(low, high, similarity)
    first = rare[: max(0, size - common + taken - lone)]
    for chosen in combinations(first, taken):
        yield xxhash.xxh64_intdigest(np.array([key, low, high, *chosen], np.int64).tobytes())


def _keyed(rows: DataFrame, similarity: float) -> DataFrame:
    """``(id, size, own, partner, key)``: keys that similar rows of a ``key`` of ``rows`` have in common.

    ``rows`` are ``(key, partner, id, shingles)``; a null ``partner`` is every bucket of sizes. Shingles are taken in the
    order of how many rows of the key have them, and similar rows have their first common ones early in it. Those that
    only one row has are in no key: they use up what may differ.
    """

    @F.arrow_udf("array<struct<own:int,partner:int,key:bigint>>")
    def keys(rare: pa.Array, lone: pa.Array, size: pa.Array, partner: pa.Array, key: pa.Array) -> pa.Array:
        sides, made, ends = [], [], [0]
        for r, n, s, one, k in zip(*(x.to_pylist() for x in (rare, lone, size, partner, key)), strict=True):
            for p in _partners(s, similarity) if one is None else [one]:
                found = list(_keys(r, n, s, p, k, similarity))
                made += found
                sides += [(_bucket(s), p)] * len(found)
            ends.append(len(made))
        own, others = np.array(sides, np.int32).reshape(-1, 2).T
        columns = [pa.array(own), pa.array(others), pa.array(np.array(made, np.uint64).view(np.int64))]
        return pa.ListArray.from_arrays(np.array(ends, np.int32), pa.StructArray.from_arrays(columns, ["own", "partner", "key"]))

    terms = rows.select("key", "partner", "id", F.explode("shingles").alias("shingle"))
    counted = terms.join(terms.groupBy("key", "shingle").agg(F.count("*").alias("n")), ["key", "shingle"])
    ranked = counted.groupBy("key", "partner", "id").agg(
        F.count("*").cast("int").alias("size"),
        F.count_if(F.col("n") == 1).cast("int").alias("lone"),
        F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.struct("n", "shingle")))).alias("rare"),
    )
    found = ranked.select("id", "size", F.explode(keys("rare.shingle", "lone", "size", "partner", "key")).alias("k"))
    return found.select("id", "size", "k.own", "k.partner", "k.key")


def _across(meeting: DataFrame, contents: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """``edges`` and the similar paragraphs on a band that they leave in different classes."""
    labels = components(edges)
    meeting = _of_several_classes(meeting, labels, "band").select("id", "band")
    every = [F.lit(0).cast("bigint").alias("key"), F.lit(None).cast("int").alias("partner")]
    rows = contents.join(meeting.select("id").distinct(), "id", "left_semi").select(*every, "id", "shingles")
    both_sides = (F.min("own") != F.max("own")) | (F.min("own") == F.min("partner"))
    keyed = _of_several_classes(_keyed(rows, similarity), labels, "key", both_sides)
    theirs = ["key", F.col("own").alias("partner"), F.col("class").alias("other"), F.col("id").alias("centre"), F.col("size").alias("others")]
    long_enough = F.least("size", "others") >= similarity * F.greatest("size", "others") - 1e-9
    for k in range(ROUNDS + 1):
        if keyed.isEmpty():
            break
        if k < ROUNDS:  # one member of the least class on the other side with all on this one
            centres = keyed.groupBy("key", "own").agg(F.min(F.struct("class", "id", "size")).alias("c"))
            met = keyed.join(centres.select("key", "own", "c.*").select(theirs), ["key", "partner"])
        else:
            met = keyed.join(keyed.select(theirs), ["key", "partner"]).where("own < partner or id < centre")
        pairs = met.where((F.col("other") != F.col("class")) & long_enough)
        pairs = pairs.select(F.least("id", "centre").alias("id"), F.greatest("id", "centre").alias("centre")).distinct()
        found = _verified(pairs, contents, similarity)
        bands = found.join(meeting.withColumnRenamed("id", "a"), "a")
        on_a_band = bands.join(meeting.withColumnRenamed("id", "b"), ["b", "band"], "left_semi")
        edges = edges.union(on_a_band.select("a", "b").distinct())
        if k < ROUNDS:
            labels = components(edges)
            keyed = _of_several_classes(keyed.drop("class"), labels, "key", both_sides)
            if not keyed.isEmpty():
                rows = keyed.select("key", "partner", "id").join(contents.select("id", "shingles"), "id")
                keyed = _of_several_classes(_keyed(rows, similarity), labels, "key", both_sides)
    return edges


def _linked(contents: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: similar rows of ``contents`` (``id``, ``shingles`` in order, ``bands``) that connect each class."""
    band = Window.partitionBy("band")
    met = contents.select("id", F.explode("bands").alias("band")).select(
        "id", "band", F.min("id").over(band).alias("low"), F.max("id").over(band).alias("high")
    )
    meeting = stored(met.where("low != high").select("id", "band", "low"))
    sets = stored(contents.join(meeting.select("id").distinct(), "id", "left_semi").select("id", "shingles"))
    edges = _verified(meeting.where("id != low").select("id", F.col("low").alias("centre")).distinct(), sets, similarity)
    return _across(meeting, sets, edges, similarity)


def repeated_paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, text_hash, id, first, words, start, stop, one, occurrences)`` of each paragraph.

    ``one`` is the first occurrence of its class as a struct of doc_id, text_hash and first word;
    ``occurrences`` counts the class. ``start`` and ``stop`` are bytes of the text.
    """
    units = stored(_listed(docs))
    labels = components(_similar(docs, units, similarity))
    by_id = units.groupBy("id").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "first")).alias("one"))
    # The least paragraph of a class is no node of its own.
    labels = labels.union(labels.select("label", "label").distinct())
    classed = by_id.join(labels, by_id["id"] == labels["node"], "left").where("n > 1 or label is not null")
    classed = stored(classed.select("id", "n", "one", F.coalesce("label", "id").alias("class")))
    whole = classed.groupBy("class").agg(F.sum("n").alias("occurrences"), F.min("one").alias("one"))
    named = classed.select("id", "class").join(whole, "class").select("id", "occurrences", "one")
    return units.drop("bands").join(named, "id", "left")


def remove_passages(docs: DataFrame, similarity: float = SIMILARITY, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``(doc_id, n_paragraphs, n_repeated_words, n_removed_words, removed, first_doc_ids)`` for each row of ``docs``.

    ``n_repeated_words`` counts the words in passages that occur elsewhere too, ``n_removed_words`` those in
    passages that occur earlier, by doc_id (a null one first). ``removed`` are the byte ranges of the latter,
    ``first_doc_ids`` the documents where their paragraphs occur first. A null, empty or short text has no
    paragraphs. Rows that repeat doc_id and text are one document here, and have equal rows. Other columns
    are not read.
    """
    marked = repeated_paragraphs(docs, similarity).select(
        "doc_id", "text_hash", "first", "words", "start", "stop", "one",
        (F.coalesce("occurrences", F.lit(0)) > 1).alias("repeated"),
    ).distinct()
    own = F.struct("doc_id", "text_hash", "first")
    marked = marked.withColumn("late", F.col("repeated") & (F.col("one") < own))
    text = Window.partitionBy("doc_id", "text_hash").orderBy("first")

    def run(flag: str) -> Column:
        gap = F.col("first") - F.lag(F.col("first") + F.col("words")).over(text) > GAP_WORDS
        return F.coalesce(gap | (F.lag(flag).over(text) != F.col(flag)), F.lit(True)).cast("int")

    numbered = marked.withColumns({"_r": run("repeated"), "_l": run("late")})
    runs = numbered.withColumns({"_r": F.sum("_r").over(text), "_l": F.sum("_l").over(text)})
    by_run = runs.withColumns(
        {
            "_in_r": F.sum("words").over(Window.partitionBy("doc_id", "text_hash", "_r")),
            "_in_l": F.sum("words").over(Window.partitionBy("doc_id", "text_hash", "_l")),
        }
    )
    passage, gone = F.col("repeated") & (F.col("_in_r") >= passage_words), F.col("late") & (F.col("_in_l") >= passage_words)
    per_text = by_run.groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_paragraphs"),
        F.sum(F.when(passage, F.col("words")).otherwise(0)).alias("n_repeated_words"),
        F.sum(F.when(gone, F.col("words")).otherwise(0)).alias("n_removed_words"),
        F.array_sort(F.collect_list(F.when(gone, F.struct("start", "stop")))).alias("removed"),
        F.array_sort(F.collect_set(F.when(gone, F.col("one.doc_id")))).alias("first_doc_ids"),
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    rows = docs.select("doc_id", F.hash("text").alias("text_hash")).alias("d").join(per_text.alias("s"), same, "left")
    zero = [F.coalesce(f"s.{c}", F.lit(0)).alias(c) for c in ("n_paragraphs", "n_repeated_words", "n_removed_words")]
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    ids = F.array().cast(T.ArrayType(docs.schema["doc_id"].dataType))
    return rows.select("d.doc_id", *zero, F.coalesce("s.removed", none).alias("removed"), F.coalesce("s.first_doc_ids", ids).alias("first_doc_ids"))
