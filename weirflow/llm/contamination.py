"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Words are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters. A window is ``n``
consecutive words of a benchmark item; an item with fewer words, but not none, is one window. Every task
scans the word sequences of its documents: words outside the benchmark's vocabulary rule windows out,
rolling hashes of the remaining positions are looked up among the window hashes, and each hit is verified
word by word.

The windows are broadcast only after their number has been counted. A benchmark above ``max_windows`` is
matched by a shuffled join of window hashes instead, with the same results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored, utf8

WINDOW = 13
MAX_WINDOWS = 200_000
_WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TO_WORDS = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())
_WORD = re.compile(b"[" + re.escape(_WORD_BYTES) + b"]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


def _windows(words: list[bytes], n: int) -> list[tuple[bytes, ...]]:
    size = min(n, len(words))
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []


class WindowSet:
    """The benchmark's windows as word numbers, with rolling hashes for the search."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            for window in _windows(words_of(text), n):
                numbers = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in window)
                owners[numbers] |= {item} - {None}
        self.owners = dict(owners)
        by_size: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for window in self.owners:
            by_size[len(window)].append(window)
        self.hashes = {
            size: np.unique(_rolling(np.array(found, np.int64), size)) for size, found in by_size.items()
        }

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """``(mask of hit words, ids of the items whose windows occur)``."""
        numbers = np.array(list(map(self.vocabulary.get, words, repeat(-1))), np.int64)
        hit = np.zeros(len(words), bool)
        items: set[str] = set()
        outside = np.concatenate(([0], np.cumsum(numbers < 0)))
        for size, hashes in self.hashes.items():
            if len(words) < size:
                continue
            starts = np.flatnonzero(outside[size:] == outside[:-size])
            if not len(starts):
                continue
            rows = numbers[starts[:, None] + np.arange(size)]
            for at, row in zip(*_matching(starts, rows, hashes, size), strict=True):
                owners = self.owners.get(tuple(row.tolist()))
                if owners is not None:
                    hit[at : at + size] = True
                    items |= owners
        return hit, items


def _rolling(rows: np.ndarray, size: int) -> np.ndarray:
    powers = np.array([pow(int(_BASE), k + 1, 1 << 64) for k in range(size)], np.uint64)
    return ((rows.astype(np.uint64) + np.uint64(1)) * powers).sum(axis=1, dtype=np.uint64)


def _matching(starts: np.ndarray, rows: np.ndarray, hashes: np.ndarray, size: int):
    found = _rolling(rows, size)
    place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    same = hashes[place] == found
    return starts[same], rows[same]


def _without(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit spans, each from the first to the last byte of a run of hit words."""
    kept, last = [], 0
    spans = [m.span() for m in _WORD.finditer(text.lower())]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    for first, end in zip(edges[::2], edges[1::2], strict=True):
        kept.append(text[last : spans[first][0]])
        last = spans[end - 1][1]
    return b"".join([*kept, text[last:]])


def _fits(items: DataFrame, max_windows: int) -> bool:
    """Whether the benchmark has at most ``max_windows`` words, and so no more windows."""
    spaced = F.regexp_replace(F.col("text"), r"[\x00-/:-@\[-`{-\x7F]+", " ")
    return (items.agg(F.sum(F.size(F.split(spaced, " ")))).first()[0] or 0) <= max_windows


def _few_at_once(texts: pa.Array) -> Iterator[bytes | None]:
    for at in range(0, len(texts), 256):
        yield from texts.slice(at, 256).cast(pa.binary()).to_pylist()


def _finder(items: DataFrame, n: int, with_text: bool):
    """A function of the text column with the broadcast windows: ``struct(n_words, n_hit, items, clean_text)``."""
    wanted = WindowSet([(r["item_id"], (r["text"] or "").encode()) for r in items.collect()], n)
    shared = items.sparkSession.sparkContext.broadcast(wanted)

    @F.arrow_udf("struct<n_words:bigint,n_hit:bigint,items:array<string>,clean_text:string>")
    def find(texts: pa.Array) -> pa.Array:
        windows = shared.value
        n_words, n_hit, owners, cleaned = [], [], [], []
        for text in _few_at_once(texts):
            words = words_of(text)
            hit, found = windows.scan(words) if words else (np.zeros(0, bool), set())
            n_words.append(len(words))
            n_hit.append(int(hit.sum()))
            owners.append(sorted(found))
            cleaned.append((_without(text, hit) if n_hit[-1] else text) if with_text else None)
        columns = [
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array(owners, pa.list_(pa.string())),
            pa.array(cleaned, pa.binary()).cast(pa.string()),
        ]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_hit", "items", "clean_text"])

    return find


def scan(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS, with_text: bool = False
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items)`` per row of ``docs``; ``items`` are item ids as strings, sorted.

    ``with_text`` adds ``clean_text``, the text without its hit spans (equal to the text where nothing is
    hit). A null or wordless text has no words and no hits; a null or wordless item has no windows; a window
    of an item without id is hit but names no item. Repeated rows have equal rows. Other columns of both
    tables are not read.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    names = ["doc_id", "n_words", "n_hit", "items"] + ["clean_text"] * with_text
    if not _fits(items, max_windows):
        return _scan_by_join(docs.select("doc_id", "text"), items, n).select(*names)
    find = _finder(items, n, with_text)
    return docs.select("doc_id", find("text").alias("_found")).select(
        "doc_id", *[F.col(f"_found.{name}").alias(name) for name in names[1:]]
    )


def _scan_by_join(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """``docs`` with what was found, for a benchmark too large to broadcast: windows of both sides meet in a shuffle."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    windows = stored(items.mapInArrow(_listed(n, None), "item_id string, size int, gram binary").distinct())
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # at most n of them
    grams = rows.select("_row", "text").mapInArrow(_listed(n, sizes), "_row long, at long, size int, gram binary")
    found = (
        grams.join(windows.drop("size"), "gram")
        .groupBy("_row")
        .agg(F.collect_set(F.struct("at", "size")).alias("_places"), F.array_sort(F.collect_set("item_id")).alias("items"))
    )

    @F.arrow_udf("struct<n_words:bigint,n_hit:bigint,clean_text:string>")
    def count(texts: pa.Array, places: pa.Array) -> pa.Array:
        n_words, n_hit, cleaned = [], [], []
        for text, spots in zip(texts.cast(pa.binary()).to_pylist(), places.to_pylist(), strict=True):
            hit = np.zeros(len(words_of(text)), bool)
            for spot in spots or ():
                hit[spot["at"] : spot["at"] + spot["size"]] = True
            n_words.append(len(hit))
            n_hit.append(int(hit.sum()))
            cleaned.append(_without(text, hit) if n_hit[-1] else text)
        columns = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(cleaned, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_hit", "clean_text"])

    return (
        rows.join(found, "_row", "left")
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("_found", count("text", "_places"))
        .select(*docs.columns, "_found.*", "items")
    )


def _listed(n: int, sizes: list[int] | None):
    """A task that lists windows: of an item all of its own, of a document those of the given sizes."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                words = words_of(text)
                if sizes is None:
                    found = [b" ".join(w) for w in _windows(words, n)]
                    size = pa.array([min(n, len(words))] * len(found), pa.int32())
                    columns = [pa.array([key] * len(found), pa.string()), size, pa.array(found, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "size", "gram"])
                else:
                    for size in sizes:
                        count = max(0, len(words) - size + 1)
                        columns = [
                            pa.array([key] * count, pa.int64()),
                            pa.array(np.arange(count)),
                            pa.array(np.full(count, size, np.int32)),
                            pa.array([b" ".join(words[k : k + size]) for k in range(count)], pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["_row", "at", "size", "gram"])

    return grams


def is_contaminated(n_hit, n_words):
    """At least a twentieth of the words lies inside benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def keep_clean(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns; a null text is kept."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    if _fits(items, max_windows):
        marked = docs.select(F.struct("*").alias("doc"), _finder(items, n, False)("text").alias("found"))
        return marked.where(~is_contaminated(F.col("found.n_hit"), F.col("found.n_words"))).select("doc.*")
    found = _scan_by_join(docs.select(F.struct("*").alias("doc"), "text"), items, n)
    return found.where(~is_contaminated(F.col("n_hit"), F.col("n_words"))).select("doc.*")
