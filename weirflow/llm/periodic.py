"""Runs of words that repeat with a period, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends. Texts are taken
together, a bounded amount at a time, and their words become numbers. The suffix array (sorted by
doubling, only groups of equal suffixes again) never compares across texts, as the text is the first part of every
rank. The common prefixes of neighbours in it are its intervals' depths.

Suffixes ``i`` and ``i + d`` in different children of an interval of depth ``d`` start a square of period ``d`` that
its next word ends: the run of that period ends there, and every run ends in such a square. So for each
boundary in the array the suffixes on its smaller side look up whether ``i + d`` or ``i - d`` stands on the other
side, by the inverse array; sides come from nearest smaller values, and no tree is built. Smaller sides
together have at most ``n log n`` suffixes. Squares of one end are rotated to the left as far as the period
holds, shortest period first, and those of its multiples are merged into its run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weirflow.llm.common import with_type

#: Texts of about so many bytes are taken together; one larger text is taken alone.
BYTES_AT_ONCE = 1 << 21
#: Longer inputs keep no ranks of earlier rounds and find common prefixes by one pass over the text.
RANKED_WORDS = 1 << 21
#: Suffixes that are looked up at once.
LOOKED_UP = 1 << 20


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's words start (with the end of the last)."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    words, offsets = split.values, np.asarray(split.offsets, np.int64)
    full = np.asarray(pc.not_equal(pc.binary_length(words), 0))
    before = np.concatenate([[0], np.cumsum(full)])
    return words.filter(pa.array(full)), before[offsets]


def suffix_order(numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, its inverse, and the ranks by the first 1, 2, 4, ... words.

    ``starts`` has where each text starts, and the end. Suffixes of different texts have different ranks from
    the beginning; the shorter of two suffixes of which one begins the other is the smaller one.
    """
    n = len(numbers)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = np.repeat(starts[1:], np.diff(starts))
    key = text * (int(numbers.max()) + 1) + numbers
    sa = np.argsort(key)
    open_at, ranks, width = np.arange(n), [], 1
    rank = np.empty(n, np.int64)
    keys = key[sa]
    while True:
        # ``open_at``: places of the array whose suffixes are not told apart yet, ``keys`` what sorts them.
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = open_at[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]
        rank[sa[open_at]] = first
        ranks.append(rank.astype(np.int32) if n < RANKED_WORDS else None)
        alone = fresh & np.concatenate([fresh[1:], [True]])
        open_at, first = open_at[~alone], first[~alone]
        if not len(open_at):
            return sa, rank, ranks
        at = sa[open_at]
        later = at + width
        inside = later < end[at]
        second = np.where(inside, rank[np.minimum(later, n - 1)] + 1, 0)
        keys = first * (n + 1) + second
        order = np.argsort(keys)
        sa[open_at] = at[order]
        keys, width = keys[order], 2 * width


def common_prefixes(numbers: np.ndarray, starts: np.ndarray, sa: np.ndarray, inverse: np.ndarray, ranks: list) -> np.ndarray:
    """For each place of the array the words its suffix has in common with the one before (0 across texts)."""
    n = len(numbers)
    end = np.repeat(starts[1:], np.diff(starts))
    common = np.zeros(n, np.int64)
    if ranks[0] is None:
        words, ends, order, places = (memoryview(np.ascontiguousarray(a)) for a in (numbers, end, sa, inverse))
        same = 0
        for i in range(n):
            k = places[i]
            j = order[k - 1] if k else 0
            if k == 0 or ends[j] != ends[i]:
                same = 0
                continue
            stop = ends[i] - max(i, j)
            while same < stop and words[i + same] == words[j + same]:
                same += 1
            common[k] = same
            same = max(same - 1, 0)
        return common
    # The places that share at least 1, 2, 4, ... words with the one before, then the other binary digits downwards.
    shared = [np.arange(1, n)]
    for rank in ranks:
        k = shared[-1]
        shared.append(k[rank[sa[k]] == rank[sa[k - 1]]])
    for level, rank in reversed(list(enumerate(ranks))):
        k = shared[level + 1]
        a, b = sa[k] + common[k], sa[k - 1] + common[k]
        inside = np.maximum(a, b) < end[sa[k]]
        a, b, k = a[inside], b[inside], k[inside]
        common[k[rank[a] == rank[b]]] += 1 << level
    return common


def _nearest(values: np.ndarray, step: int, equal_stops: bool) -> np.ndarray:
    """For each place the nearest one in direction ``step`` whose value is smaller (or equal, where that stops).

    A place points at its neighbour and, while that is no stop, on to where the neighbour points: all
    values between are at least the neighbour's. Both ends of ``values`` must stop everything.
    """
    at = np.arange(len(values)) + step
    todo = np.arange(1, len(values) - 1)
    while len(todo):
        theirs = values[at[todo]]
        todo = todo[theirs > values[todo] if equal_stops else theirs >= values[todo]]
        at[todo] = at[at[todo]]
    return at


def squares(sa: np.ndarray, inverse: np.ndarray, common: np.ndarray, end: np.ndarray, length: np.ndarray, times: int) -> np.ndarray:
    """``(end, period)`` of all branching squares whose period fits ``times`` into their text, sorted, each once."""
    n = len(sa)
    depth = np.concatenate([common, [0]])
    # Places of one text and first word: everything else has depth 0 and takes part in nothing.
    left = _nearest(np.concatenate([[-1], depth, [-1]]), -1, False)[1:-1] - 1
    right = _nearest(np.concatenate([[-1], depth, [-1]]), 1, True)[1:-1] - 1
    node = np.flatnonzero((common > 0) & (common * times <= length[sa]))
    lows, highs = left[node], right[node]
    small_left = node - lows <= highs - node
    count = np.where(small_left, node - lows, highs - node)
    first = np.where(small_left, lows, node)
    other_low, other_high = np.where(small_left, node, lows), np.where(small_left, highs, node)
    found = []
    ends = np.cumsum(count)
    done = 0
    while done < len(node):
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + LOOKED_UP, "right")))
        part = slice(done, stop)
        of = np.repeat(np.arange(done, stop), count[part])
        at = first[of] + np.arange(len(of)) - np.repeat(ends[part] - count[part] - (ends[done - 1] if done else 0), count[part])
        suffix, period = sa[at], common[node[of]]
        for start in (suffix, suffix - period):
            partner = suffix + period if start is suffix else start
            valid = (partner >= 0) & (partner < end[suffix])
            place = inverse[np.where(valid, partner, 0)]
            hit = valid & (place >= other_low[of]) & (place < other_high[of])
            found.append(np.stack([start[hit] + 2 * period[hit], period[hit]], axis=1))
        done = stop
    every = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return np.unique(every, axis=0)


def _rotated(numbers: np.ndarray, start: int, end: int, period: int) -> int:
    """Where the stretch before ``end`` with this period starts, not before ``start``."""
    at, block = end - 2 * period, 16
    while at > start:
        low = max(start, at - block)
        other = np.flatnonzero(numbers[low:at] != numbers[low + period : at + period])
        if len(other):
            return low + int(other[-1]) + 1
        at, block = low, min(2 * block, 1 << 20)
    return at


def runs(numbers: np.ndarray, starts: np.ndarray, min_times: int = 4, min_length: int = 6) -> np.ndarray:
    """``(text, start, length, period)`` of all runs, in the order of text, start and period; starts count within the text.

    A run is at least ``min_length`` words and ``min_times`` (2 or more) periods long.
    """
    if min_times < 2:
        raise ValueError("a run has two periods at least")
    if not len(numbers):
        return np.zeros((0, 4), np.int64)
    sa, inverse, ranks = suffix_order(numbers, starts)
    common = common_prefixes(numbers, starts, sa, inverse, ranks)
    sizes = np.diff(starts)
    text_end, text_start = np.repeat(starts[1:], sizes), np.repeat(starts[:-1], sizes)
    found = squares(sa, inverse, common, text_end, np.repeat(sizes, sizes), min_times)
    # How far the period must go on before the square; the farthest word and the nearest ones drop most.
    stop, period = found[:, 0], found[:, 1]
    more = np.maximum(min_times * period, min_length) - 2 * period
    before = stop - 2 * period
    able = before - more >= text_start[np.minimum(stop, len(numbers)) - 1]
    for back in (more, np.minimum(more, 1), np.minimum(more, 2), np.minimum(more, 3)):
        x = np.where(able, before - back, 0)
        able &= (back == 0) | (numbers[x] == numbers[np.minimum(x + period, len(numbers) - 1)])
    out = []
    stop, period = stop[able], period[able]
    cuts = np.flatnonzero(np.diff(stop)) + 1
    for same_end, periods in zip(np.split(stop, cuts), np.split(period, cuts), strict=True) if len(stop) else ():
        last = int(same_end[0])
        low = int(text_start[last - 1])
        while len(periods):
            q = int(periods[0])
            start = _rotated(numbers, low, last, q)
            if last - start >= max(min_times * q, min_length):
                out.append((low, start - low, last - start, q))
            # A square of a multiple that lies inside is no other run.
            periods = periods[(periods % q != 0) | (last - 2 * periods < start)]
    out.sort(key=lambda run: (run[0], run[1], run[3]))
    table = np.array(out, np.int64).reshape(-1, 4)
    table[:, 0] = np.searchsorted(starts, table[:, 0], "right") - 1
    return table


def _batched(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices of at most ``BYTES_AT_ONCE``, or of one larger text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BYTES_AT_ONCE, "right")))
        yield at, n
        at += n


SCHEMA = "n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string, n_dropped bigint"


def collapse(
    docs: DataFrame,
    min_times: int = 4,
    min_length: int = 6,
    rewrite: Callable[[list, np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed, n_dropped)``: the periodic runs of each text, and the text with one period of each.

    Words are what lies between ASCII white space. ``runs`` has ``(start, length, period)`` in words, by start and
    period. A word goes if a run holds it after its first period; ``collapsed`` has the others, joined by a space.
    ``rewrite(doc_ids, numbers, starts)`` may give the texts' words anew before runs are searched, by numbers.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated rows have equal rows, and other
    columns are not read. Texts are processed whole: memory is a few hundred bytes for each word of the longest
    text or of two megabytes. An empty table has no rows.
    """
    fields = T.StructType([with_type(docs, "doc_id"), *T.StructType.fromDDL(SCHEMA)])
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def found(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, starts = _words(texts)
        coded = words.dictionary_encode()
        numbers = np.asarray(coded.indices, np.int64)
        if rewrite is not None:
            numbers = rewrite(ids.to_pylist(), numbers, starts)
        table = runs(numbers, starts, min_times, min_length)
        begin = starts[table[:, 0]] + table[:, 1]
        depth = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(depth, begin + table[:, 3], 1)
        np.add.at(depth, begin + table[:, 2], -1)
        kept = np.cumsum(depth[:-1]) == 0
        kept_before = np.concatenate([[0], np.cumsum(kept)])[starts]
        left = coded.dictionary.take(pa.array(numbers[kept]))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_before.astype(np.int32)), left), " ")
        per_text = pa.array(np.searchsorted(table[:, 0], np.arange(len(texts) + 1)).astype(np.int32))
        structs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
        columns = [
            ids,
            pa.array(np.diff(starts)),
            pa.ListArray.from_arrays(per_text, structs).cast(run_type),
            joined,
            pa.array(np.diff(starts) - np.diff(kept_before)),
        ]
        return pa.RecordBatch.from_arrays(columns, fields.fieldNames())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for at, n in _batched(texts):
                yield found(ids.slice(at, n), texts.slice(at, n))

    return docs.select("doc_id", "text").mapInArrow(search, fields)
