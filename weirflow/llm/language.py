"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, the same in every task because it is drawn from a seed and
the letter's code point. A letter trigram is the product of its three vectors, the first rotated by two
places and the second by one, so that order counts; the edge of a word stands for a letter too. A text's
vector is the sum of its trigrams' vectors, a language's prototype the sum over its training texts, and a
text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import held

DIMENSIONS = 1024
SEED = 7
UNKNOWN = "und"
MIN_SCORE = 0.1
_TEXTS_AT_ONCE = 32
_CHARS_AT_ONCE = 1 << 17
_CACHED_TRIGRAMS = 1 << 14
_TRIGRAMS_AT_ONCE = 1 << 11


class Profiles:
    """Turns texts into vectors, and remembers the letters and trigrams it has met."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.place = np.full(0x110000, -1, np.int32)  # of a code point among the letters; 0: no letter
        self.place[0] = 0
        self.letters = [self._random(0)]
        self.turned: list[np.ndarray] = []
        self.row: dict[int, int] = {}
        self.vectors = np.zeros((0, dimensions), np.int8)

    def _random(self, code: int) -> np.ndarray:
        draw = np.random.Generator(np.random.Philox(key=np.array([self.seed, code], np.uint64)))
        return (2 * draw.integers(0, 2, self.dimensions, np.int8) - 1).astype(np.int8)

    def _numbers(self, codes: np.ndarray) -> np.ndarray:
        found = self.place[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                letter = chr(code).isalpha()
                self.place[code] = len(self.letters) if letter else 0
                if letter:
                    self.letters.append(self._random(code))
            self.turned = []
            found = self.place[codes]
        return found

    def _rows(self, trigrams: np.ndarray) -> np.ndarray:
        if len(self.row) > _CACHED_TRIGRAMS:
            self.row, self.vectors = {}, self.vectors[:0]
        new = [t for t in trigrams.tolist() if t not in self.row]
        if new:
            if not self.turned:
                letters = np.array(self.letters)
                self.turned = [np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters]
            code = np.array(new, np.int64)
            parts = (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF)
            first, second, third = (turned[p] for turned, p in zip(self.turned, parts, strict=True))
            self.row.update(zip(new, range(len(self.vectors), len(self.vectors) + len(new)), strict=True))
            self.vectors = np.concatenate([self.vectors, first * second * third])
        return np.array([self.row[t] for t in trigrams.tolist()], np.int64)

    def bundles(self, texts: list[str], group: np.ndarray, groups: int) -> np.ndarray:
        """The sum of the trigram vectors of the texts of each group, as whole numbers."""
        total = np.zeros((groups, self.dimensions), np.float64)
        pieces, owner, size = [], [], 0
        for text, of in zip(texts, group.tolist(), strict=True):
            text = text.lower()
            for at in range(0, max(1, len(text)), _CHARS_AT_ONCE):
                # Long texts come in parts that overlap by two letters, so that no trigram is lost or counted twice.
                part = text[max(0, at - 2) : at + _CHARS_AT_ONCE]
                pieces.append(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4"))
                owner.append((of, at == 0, at + _CHARS_AT_ONCE >= len(text)))
                size += len(part)
                if size >= _CHARS_AT_ONCE or len(pieces) == _TEXTS_AT_ONCE:
                    total += self._bundled(pieces, owner, groups)
                    pieces, owner, size = [], [], 0
        if pieces:
            total += self._bundled(pieces, owner, groups)
        return total

    def _bundled(self, pieces, owner, groups: int) -> np.ndarray:
        codes, of = [], []
        for piece, (group, opens, closes) in zip(pieces, owner, strict=True):
            edged = [np.zeros(int(opens), np.int32), self._numbers(piece), np.zeros(int(closes), np.int32)]
            codes += edged + [np.full(1, -1, np.int32)]
            of.append(np.full(sum(map(len, edged)) + 1, group))
        code, group = np.concatenate(codes), np.concatenate(of)
        # One edge between words; -1 parts texts.
        some = np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))
        code, group = code[some].astype(np.int64), group[some]
        use = (code[1:-1] > 0) & (code[:-2] >= 0) & (code[2:] >= 0)
        trigrams = (code[:-2] << 42 | code[1:-1] << 21 | code[2:])[use]
        known, which = np.unique(trigrams, return_inverse=True)
        if not len(known):
            return np.zeros((groups, self.dimensions))
        counts = np.bincount(group[1:-1][use] * len(known) + which, minlength=groups * len(known))
        rows, counts = self._rows(known), counts.reshape(groups, -1).astype(np.float32)
        total = np.zeros((groups, self.dimensions))
        for low in range(0, len(rows), _TRIGRAMS_AT_ONCE):
            some = slice(low, low + _TRIGRAMS_AT_ONCE)
            # Exact: the sums are whole numbers far below 2 ** 24.
            total += counts[:, some] @ self.vectors[rows[some]].astype(np.float32)
        return total


def profiles(dimensions: int, seed: int) -> Profiles:
    """The profiles of this Python process."""
    return held((Profiles, dimensions, seed), lambda: Profiles(dimensions, seed))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED, max_languages: int = 2000) -> dict[str, np.ndarray]:
    """Prototypes by language from the rows of ``docs`` whose ``text`` and ``lang`` are not null.

    Every task bundles its texts by language; only those sums are shuffled. The prototypes, at most
    ``max_languages`` vectors, come to the driver.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = Profiles(dimensions, seed), {}
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                texts, langs = some.column(0).to_pylist(), some.column(1).to_pylist()
                names = sorted(set(langs))
                at = {name: k for k, name in enumerate(names)}
                total = known.bundles(texts, np.array([at[x] for x in langs], np.int64), len(names))
                del texts
                for name, row in zip(names, total, strict=True):
                    sums[name] = sums.get(name, 0) + row
        if sums:
            rows = [pa.array(np.rint(v).astype(np.int64)) for v in sums.values()]
            lists = pa.array([r.to_pylist() for r in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), lists], ["lang", "v"])

    sums = (
        docs.where("text is not null and lang is not null")
        .select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(bundle, "lang string, v array<bigint>")
        .select("lang", F.posexplode("v").alias("k", "x"))
        .groupBy("lang", "k")
        .agg(F.sum("x").alias("x"))
        .limit(max_languages * dimensions + 1)
        .collect()
    )
    if len(sums) > max_languages * dimensions:
        raise ValueError(f"more than {max_languages} languages")
    found: dict[str, np.ndarray] = {}
    for row in sums:
        found.setdefault(row["lang"], np.zeros(dimensions))[row["k"]] = row["x"]
    return {lang: v for lang, v in sorted(found.items()) if v.any()}


def predictor(prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = SEED):
    """A function of a text column: ``struct(lang_pred, score)``.

    ``score`` is the cosine, 0 where it is negative. A text that is null or has no letter, and any text if
    nothing was learned, gets ``und`` and 0. Equal cosines go to the language that is first in the alphabet.
    """
    names = list(prototypes)
    matrix = np.array([v / np.linalg.norm(v) for v in prototypes.values()]).reshape(len(names), dimensions)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        known, langs, scores = profiles(dimensions, seed), [], []
        for at in range(0, len(texts), _TEXTS_AT_ONCE):
            some = [x or "" for x in texts.slice(at, _TEXTS_AT_ONCE).to_pylist()]
            vectors = known.bundles(some, np.arange(len(some)), len(some))
            norms = np.linalg.norm(vectors, axis=1)
            if not names:
                norms[:] = 0
            cosines = vectors @ matrix.T / np.where(norms > 0, norms, 1)[:, None] if names else np.zeros((len(some), 1))
            best = cosines.argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                langs.append(names[b] if norms[k] > 0 else UNKNOWN)
                scores.append(float(min(1, max(0, cosines[k, b]))) if norms[k] > 0 else 0.0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, training: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row of ``docs``; prototypes are learned from ``training``.

    ``training`` needs ``text`` and ``lang`` and should be a bounded or whole set of labelled rows. Repeated
    rows have equal rows. Other columns are not read.
    """
    predict = predictor(train(training, dimensions, seed), dimensions, seed)
    found = docs.select("doc_id", predict("text").alias("_p"))
    return found.select("doc_id", "_p.lang_pred", "_p.score")


def keep_recognised(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with the same columns.

    Learns from the rows that are not held out. Rejected are texts without a letter (also null and empty
    ones) and those whose best cosine is below ``min_score``: they look like none of the languages. If
    nothing can be learned, every text that is not blank stays.
    """
    prototypes = train(docs.where(~held_out(F.col("doc_id"))))
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    marked = docs.select(F.struct("*").alias("doc"), predictor(prototypes)("text").alias("found"))
    return marked.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score)).select("doc.*")
