"""Source divergence audit by single-pass in-memory indexing.

Which words make a source differ from the others of its language, and by how much. Each task counts
postings, for a language and term the occurrences in each source and the language's documents, in a block in
memory. When the block is full it is spilled as a run: its postings in the order of the terms, dealt to hash
shards, in pages. A shard then merges the pages of all its runs with a heap, opening a page only when the merge
has come near its first term, so that it holds about one page of each run. Beyond ``FAN_IN`` runs they are merged in
rounds. What comes out are the frequencies of each term, complete and once.

Smoothed shares follow from the frequencies. The distance of two sources is a sum over all terms of their
language, of which most occur in neither: those have the same share in all of them, so the sum starts as if no
term occurred, and the postings are streamed once more to correct it for the terms that do.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import stored
from weirflow.session import broadcast_if_small

SCALE = 1_000_000_000
SMOOTH = 5
MIN_DOCS = 30
TOP = 50

SHARDS = 256
BLOCK_ENTRIES = 400_000
PAGE_ENTRIES = 1024
FAN_IN = 4096
# Pages that a merge opens before it settles what lies before the next one, and rows that it holds unsummed.
OPENED, HELD = 64, 1 << 17
# Cells of shares that are compared at once, and of sums that a task holds before it passes them on.
CELLS = 1 << 21

#: Letters A-Z are lower-cased, they and all bytes above ASCII are kept, everything else parts terms.
_TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_PIECE = 1 << 20

PAGES = (
    "shard int, run bigint, first binary, terms array<binary>, places array<int>, "
    "langs array<binary>, sources array<string>, groups array<int>, counts array<bigint>"
)
# Entries: occurrences of a term in a source of a language, or, without a source, the language's documents that have it.
ENTRY = pa.schema([("term", pa.binary()), ("lang", pa.binary()), ("source", pa.string()), ("n", pa.int64())])


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded part at a time."""
    spaced = text.translate(_TERM_BYTES)
    at = 0
    while at < len(spaced):
        end = len(spaced) if at + _PIECE >= len(spaced) else spaced.find(b" ", at + _PIECE)
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end


class Block:
    """Postings of some documents."""

    def __init__(self) -> None:
        self.counts: dict[tuple[bytes, str], Counter] = defaultdict(Counter)
        self.docs: dict[bytes, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: bytes, source: str, text: bytes) -> None:
        counts, docs = self.counts[lang, source], self.docs[lang]
        before, pieces = len(counts), _pieces(text)
        first = next(pieces, [])
        counts.update(first)
        seen = set(first)
        for terms in pieces:
            counts.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.size += len(counts) - before

    def entries(self) -> pa.Table:
        of = [*((lang, None, terms) for lang, terms in self.docs.items()), *((*key, terms) for key, terms in self.counts.items())]
        sizes = [len(terms) for _, _, terms in of]
        each = pa.array(np.repeat(np.arange(len(of)), sizes))
        columns = [
            pa.chunked_array([pa.array(terms.keys(), pa.binary()) for _, _, terms in of], pa.binary()).combine_chunks(),
            pa.array([lang for lang, _, _ in of], pa.binary()).take(each),
            pa.array([source for _, source, _ in of], pa.string()).take(each),
            pa.chunked_array([pa.array(terms.values(), pa.int64()) for _, _, terms in of], pa.int64()).combine_chunks(),
        ]
        return pa.table(columns, schema=ENTRY)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _paged(entries: pa.Table, run: int, shards: int) -> Iterator[pa.RecordBatch]:
    """The entries as pages of a run: dealt to shards by their term, each shard's in the order of the terms.

    A page has every term and every group of it once, and its entries name both by number.
    """
    n = entries.num_rows
    if not n:
        return
    coded, lang, source = (entries[c].combine_chunks().dictionary_encode() for c in ("term", "lang", "source"))
    terms = coded.dictionary.to_pylist()
    rank = np.empty(len(terms), np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    shard_of = np.array([xxhash.xxh32_intdigest(term) % shards for term in terms], np.int64)
    codes = np.asarray(coded.indices)
    sort = np.argsort(shard_of[codes] * len(terms) + rank[codes])
    codes, counts = codes[sort], entries["n"].combine_chunks().take(pa.array(sort))
    # Groups without a source have number 0 of their language.
    width = len(source.dictionary) + 1
    group = (np.asarray(lang.indices, np.int64) * width + np.asarray(source.indices.fill_null(-1)) + 1)[sort]

    place, shard = np.arange(n), shard_of[codes]
    new = np.append(True, shard[1:] != shard[:-1])
    new |= (place - place[new][np.cumsum(new) - 1]) % PAGE_ENTRIES == 0
    starts, page = place[new], np.cumsum(new) - 1
    first = np.flatnonzero(new | np.append(True, codes[1:] != codes[:-1]))
    own, number = np.unique(page * (len(lang.dictionary) * width) + group, return_inverse=True)
    own_page, own_group = np.divmod(own, len(lang.dictionary) * width)
    pages = np.arange(len(starts) + 1)
    own_starts, term_starts = np.searchsorted(own_page, pages), np.append(np.searchsorted(first, starts), len(first))
    own_source = own_group % width - 1
    columns = [
        pa.array(shard[starts].astype(np.int32)),
        pa.array(np.full(len(starts), run)),
        coded.dictionary.take(pa.array(codes[starts])),
        _lists(term_starts, coded.dictionary.take(pa.array(codes[first]))),
        _lists(term_starts, pa.array(np.diff(np.append(first, n)).astype(np.int32))),
        _lists(own_starts, lang.dictionary.take(pa.array(own_group // width))),
        _lists(own_starts, source.dictionary.take(pa.array(own_source, mask=own_source < 0))),
        _lists(np.append(starts, n), pa.array((number - own_starts[page]).astype(np.int32))),
        _lists(np.append(starts, n), counts),
    ]
    out = pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PAGES.split(", ")])
    for at in range(0, len(starts), 256):
        yield out.slice(at, 256)


def runs(docs: DataFrame, block_entries: int = BLOCK_ENTRIES, shards: int = SHARDS) -> DataFrame:
    """The spilled runs of ``docs`` (``lang``, ``source``, ``text``, no nulls)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, n_runs = TaskContext.get().partitionId(), Block(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                langs, sources, texts = (c.slice(at, 64) for c in batch.columns)
                rows = zip(langs.cast(pa.binary()).to_pylist(), sources.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True)
                for lang, source, text in rows:
                    block.add(lang, source, text)
                    if block.size >= block_entries:
                        yield from _paged(block.entries(), task << 24 | n_runs, shards)
                        block, n_runs = Block(), n_runs + 1
        yield from _paged(block.entries(), task << 24 | n_runs, shards)

    return docs.select("lang", "source", "text").mapInArrow(index, PAGES)


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(["term", "lang", "source"]).aggregate([("n", "sum")]).rename_columns(ENTRY.names)


def merged(pages: Iterable[pa.Table]) -> Iterator[pa.Table]:
    """The summed entries of all pages, which come in the order of their first terms; each term is in one table only.

    A heap has the open pages by the first term that has not been taken from them. What lies before the next page
    is complete, and is cut off the pages at the top.
    """
    heap: list[tuple[bytes, int, pa.Table]] = []

    def settle(bound: bytes | None) -> Iterator[pa.Table]:
        taken, held = [], 0
        while heap and (bound is None or heap[0][0] < bound):
            _, number, page = heap[0]
            terms = page["term"].chunk(0)
            cut = page.num_rows if bound is None else bisect_left(range(page.num_rows), bound, key=lambda k: terms[k].as_py())
            taken.append(page.slice(0, cut))
            held += cut
            if cut < page.num_rows:
                heapq.heapreplace(heap, (terms[cut].as_py(), number, page.slice(cut)))
            else:
                heapq.heappop(heap)
            if held > HELD:
                taken = [_summed(taken)]
                held = 0
        if taken:
            yield _summed(taken)

    for number, page in enumerate(pages):
        first = page["term"][0].as_py()
        if number % OPENED == OPENED - 1:
            yield from settle(first)
        heapq.heappush(heap, (first, number, page))
    yield from settle(None)


def _page_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
    """``(shard, run, entries)`` of each page, few of them unpacked at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, OPENED):
            part = batch.slice(at, OPENED)
            shards, page_runs, _ = (column.to_pylist() for column in part.columns[:3])
            terms, places, langs, sources, groups, counts = (column.flatten() for column in part.columns[3:])
            sizes = part.column(7).value_lengths().to_numpy()
            before = np.append(0, np.cumsum(part.column(5).value_lengths().to_numpy()))[:-1]
            group = pa.array(np.asarray(groups) + np.repeat(before, sizes))
            term = pa.array(np.repeat(np.arange(len(terms)), np.asarray(places)))
            entries = pa.table([terms.take(term), langs.take(group), sources.take(group), counts], schema=ENTRY)
            for shard, run, start, size in zip(shards, page_runs, np.cumsum(sizes) - sizes, sizes, strict=True):
                yield shard, run, entries.slice(start, size)


def merged_runs(pages: DataFrame, fan_in: int = FAN_IN, shards: int = SHARDS) -> DataFrame:
    """Runs merged in rounds until no shard has more than ``fan_in`` of them."""
    while (n := pages.agg(F.count_distinct("run")).first()[0]) > fan_in:
        groups = -(-n // fan_in)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (_, run), of_shard in groupby(_page_tables(batches), key=lambda page: page[:2]):
                for entries in merged(page for _, _, page in of_shard):
                    yield from _paged(entries, run, shards)

        grouped = pages.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(groups)))
        dealt = grouped.repartition("shard", "run").sortWithinPartitions("shard", "run", "first")
        pages = stored(dealt.mapInArrow(merge, PAGES))
    return pages


def _kept(entries: pa.Table, min_docs: int) -> pa.RecordBatch:
    """Occurrences of the terms that enough documents of their language have."""
    key = pc.binary_join_element_wise(entries["term"], entries["lang"], b"\0")
    in_docs = pc.is_null(entries["source"])
    often = key.filter(pc.and_(in_docs, pc.greater_equal(entries["n"], min_docs)))
    chosen = entries.filter(pc.and_(pc.invert(in_docs), pc.is_in(key, often))).combine_chunks()
    columns = [chosen["lang"].cast(pa.string()), chosen["term"].cast(pa.string()), chosen["source"], chosen["n"]]
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in columns], ["lang", "term", "source", "n"])


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block_entries: int = BLOCK_ENTRIES, shards: int = SHARDS, fan_in: int = FAN_IN) -> DataFrame:
    """``(lang, term, source, n)``: occurrences, of terms that are in at least ``min_docs`` documents of the language."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, of_shard in groupby(_page_tables(batches), key=lambda page: page[0]):
            for entries in merged(page for _, _, page in of_shard):
                yield _kept(entries, min_docs)

    pages = merged_runs(stored(runs(docs, block_entries, shards)), fan_in, shards)
    dealt = pages.repartition("shard").sortWithinPartitions("shard", "first")
    return dealt.mapInArrow(merge, "lang string, term string, source string, n bigint")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in billionths, in whole numbers throughout."""
    above = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + SMOOTH * terms).cast("decimal(20,0)")
    return 1 + F.call_function("div", above, below)


def _corrections(frequency: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """``(lang, source, item, twice)``: what the terms that occur change, each unordered pair's share in two halves.

    A task reads the groups of a language, then its postings. An entry meets all groups of its language: where
    the other one has the term too, both entries count once, else the one counts twice.
    """
    kinds = "shard int, lang string, side int, term string, source string, p bigint"
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    own = groups.select(all_shards.alias("shard"), "lang", F.lit(0).alias("side"), F.lit("").alias("term"), "source", F.col("z").alias("p"))
    entry = frequency.select(
        F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard"), "lang", F.lit(1).alias("side"), "term", "source", "p"
    )
    dealt = own.unionByName(entry).select(*[c.split()[0] for c in kinds.split(", ")])
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "lang", "side", "term", "source")

    def out(lang: str, names: list[str], sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, row in sums.items():
            to = np.flatnonzero(row)
            named = ([lang] * len(to), [names[a]] * len(to), [names[b] for b in to])
            columns = [*(pa.array(c, pa.string()) for c in named), pa.array(row[to], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "twice"])

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for at in range(0, batch.num_rows, 2048) for row in zip(*(c.to_pylist() for c in batch.slice(at, 2048).columns), strict=True))
        for (_, lang), of_lang in groupby(rows, key=lambda row: row[:2]):
            names, zero, sums = [], [], {}
            postings: list[tuple[list[int], list[int]]] = []
            held, z, number = 0, None, {}
            for _, term in groupby(of_lang, key=lambda row: row[2:4]):
                group = list(term)
                if group[0][2] == 0:
                    names, zero = [row[4] for row in group], [row[5] for row in group]
                    z, number = np.array(zero, np.int64), {name: k for k, name in enumerate(names)}
                    continue
                postings.append(([number[row[4]] for row in group], [row[5] for row in group]))
                held += len(group)
                if held * len(names) >= CELLS:
                    _correct(postings, z, sums)
                    postings, held = [], 0
                    if len(sums) * len(names) >= CELLS:
                        yield from out(lang, names, sums)
                        sums = {}
            _correct(postings, z, sums)
            yield from out(lang, names, sums)

    return dealt.mapInArrow(correct, "lang string, source string, item string, twice bigint")


def _correct(postings: list[tuple[list[int], list[int]]], zero: np.ndarray, sums: dict[int, np.ndarray]) -> None:
    """Add the corrections of some terms to ``sums``, a row of all groups for each group that has one of them."""
    for at in range(0, len(postings), max(1, CELLS // len(zero))):
        part = postings[at : at + max(1, CELLS // len(zero))]
        lengths = [len(groups) for groups, _ in part]
        term = np.repeat(np.arange(len(part)), lengths)
        group = np.array([g for groups, _ in part for g in groups], np.int64)
        share = np.array([p for _, shares in part for p in shares], np.int64)
        shares = np.broadcast_to(zero, (len(part), len(zero))).copy()
        shares[term, group] = share
        weight = np.full(shares.shape, 2, np.int64)
        weight[term, group] = 1
        # Entries of one group together: a group has one row of sums.
        for own in np.unique(group):
            k = np.flatnonzero(group == own)
            t = term[k]
            change = np.abs(shares[t] - share[k, None]) - np.abs(zero - zero[own])
            row = (change * weight[t]).sum(axis=0)
            row[own] = 0
            sums[own] = sums[own] + row if own in sums else row


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_entries: int = BLOCK_ENTRIES, shards: int = SHARDS, fan_in: int = FAN_IN
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source of a language differs from the others.

    Terms are runs of ASCII letters and characters above ASCII, with A-Z lower-cased; those in at least
    ``min_docs`` documents of the language are kept. A group's or language's share of a kept term is
    ``1 + floor(10^9 (count + 5) / (N + 5 V))``, with V kept terms that occur N times in it. Part ``pair`` has for
    each other source of the language the sum of the distances of their shares, and part ``term`` the ``top`` terms that the
    source has and whose share is above the language's. Ranks count from 1 by falling value, then by item.

    Null texts, languages and sources are read as empty ones. Groups without any term are in part ``pair`` too; a
    source alone in its language has no such row. Repeated rows count each time, and other columns are not
    read. An empty table has no rows. Texts are processed whole; a task holds one block of about
    ``block_entries`` postings and, of a language, one row of shares for each of its sources.
    """
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = stored(frequencies(read, min_docs, block_entries, shards, fan_in))
    terms = counted.groupBy("lang").agg(F.count_distinct("term").alias("v"))
    n = counted.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = stored(
        read.groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one")
        .join(n, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0, ["n", "v"])
        .withColumn("z", F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"))))
    )
    known = broadcast_if_small(groups)
    entries = counted.withColumnRenamed("n", "count").join(known, ["lang", "source"])
    shared = stored(entries.select("lang", "source", "term", "count", "v", _share(F.col("count"), F.col("n"), F.col("v")).alias("p")))

    change = _corrections(shared, groups.where("v > 0"), shards)
    twice = stored(change.groupBy("lang", "source", "item").agg(F.sum("twice").alias("twice")))
    both = stored(
        twice.union(twice.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "twice"))
        .groupBy("lang", "source", "item").agg(F.shiftright(F.sum("twice"), 1).alias("change"))
    )
    other = broadcast_if_small(groups.select("lang", F.col("source").alias("item"), F.col("z").alias("zi")))
    start = F.coalesce(F.col("v") * F.abs(F.col("z") - F.col("zi")), F.lit(0))
    pairs = (
        groups.join(other, "lang").where("source != item").join(both, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", (start + F.coalesce("change", F.lit(0))).alias("value"))
    )

    by_term = counted.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"), F.count_distinct("term").alias("of"))
    language = by_term.join(broadcast_if_small(stored(totals)), "lang").select("lang", "term", _share(F.col("all"), F.col("total"), F.col("of")).alias("q"))
    above = shared.join(language, ["lang", "term"]).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    # Part terms: only the first ones of a group survive the tasks before the shuffle.
    best = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(best)
