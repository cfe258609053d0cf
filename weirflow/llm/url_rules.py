"""URL rules as one bit-parallel wildcard automaton (multiword Shift-And).

All glob rules are packed into the bits of a few 64-bit words: a rule has a bit for its start and one for
each literal. Reading a byte moves every rule on at once: bits shift by one and stay where the rule has that
byte, and bits in front of a star stay where they are. Numpy steps a block of URLs together, so a byte costs
a few operations on words for all rules and URLs.

A URL is read in the form ``host/path?query``, with the host in lower case, where the path keeps its own
slash (``example.org//en/1``). In a glob ``*`` stands for any bytes but slashes, ``**`` for any bytes and
``?`` for one byte but a slash; a glob has to match the whole form.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
_BLOCK_BYTES = 1 << 22
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> list[str]:
        return [f"{self.host}/{self.path}**", f"*.{self.host}/{self.path}**"]


class Automaton:
    """Which of ``globs`` match whole byte strings."""

    def __init__(self, globs: list[str]):
        parsed = [_parse(g) for g in globs]
        first = np.cumsum([0, *(len(literals) + 1 for literals, _ in parsed)])
        words = max(1, -(-int(first[-1]) // 64))
        moves, stays = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        self.final = first[:-1] + [len(literals) for literals, _ in parsed]

        def put(table: np.ndarray, state: int, allowed: np.ndarray | slice) -> None:
            table[allowed, state // 64] |= np.uint64(1 << state % 64)

        no_slash = np.flatnonzero(np.arange(256) != ord("/"))
        for at, (literals, stars) in zip(first[:-1].tolist(), parsed, strict=True):
            self.start[at // 64] |= np.uint64(1 << at % 64)
            for k, literal in enumerate(literals):
                put(moves, at + k + 1, no_slash if literal is None else slice(literal, literal + 1))
            for k, crosses in stars.items():
                put(stays, at + k, slice(None) if crosses else no_slash)
        self.moves, self.stays = moves, stays

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row per text and a column per glob."""
        out = np.zeros((len(texts), len(self.final)), bool)
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        at = 0
        while at < len(order):
            longest = max(1, int(sizes[order[at]]))
            rows = order[at : at + max(1, _BLOCK_BYTES // longest)]
            out[rows] = self._match([texts[k] for k in rows.tolist()], sizes[rows])
            at += len(rows)
        return out

    def _match(self, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        width = int(sizes[0])  # the longest comes first
        table = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        for k in range(width):
            live = int(np.searchsorted(-sizes, -k, side="left"))  # texts of more than k bytes
            byte, now = table[:live, k], state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.moves[byte]) | (now & self.stays[byte])
        word, bit = self.final // 64, (self.final % 64).astype(np.uint64)
        return (state[:, word] >> bit & np.uint64(1)).astype(bool)


def _parse(glob: str) -> tuple[list[int | None], dict[int, bool]]:
    """Literals (``None``: any byte but a slash), and the places of stars with whether they cross slashes."""
    raw, literals, stars, k = glob.encode(), [], {}, 0
    while k < len(raw):
        if raw[k : k + 1] == b"*":
            wide = raw[k : k + 2] == b"**"
            stars[len(literals)] = stars.get(len(literals), False) or wide
            k += 1 + wide
        else:
            literals.append(None if raw[k : k + 1] == b"?" else raw[k])
            k += 1
    return literals, stars


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z in lower case), path, and the query with its question mark; all empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    rest = rest.partition("#")[0]
    before, mark, query = rest.partition("?")
    host, slash, path = before.partition("/")
    return host.translate(_ASCII_LOWER), slash + path, mark + query


def judge(pages: DataFrame, rules: list[Rule], blocked: list[str]) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages`` (``page_id``, ``url``).

    The longest of ``rules`` that fits decides; of two equally long ones one that blocks. Where none fits,
    ``rule`` is null and the URL is blocked if it matches a glob of ``blocked``, else allowed. A null url,
    or one without ``://``, has an empty host and path and is allowed unless a glob matches ``/``. Repeated
    rows have equal rows; other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
    automaton = Automaton([g for r in ranked for g in r.globs] + blocked)

    @F.arrow_udf("struct<host:string,path:string,rule:string,verdict:string>")
    def decide(urls: pa.Array) -> pa.Array:
        parts = [split_url(u) for u in urls.to_pylist()]
        found = automaton.match([f"{h}/{p}{q}".encode() for h, p, q in parts])
        fits = found[:, : 2 * len(ranked)].reshape(len(parts), len(ranked), 2).any(axis=2)
        other = found[:, 2 * len(ranked) :].any(axis=1)
        names, verdicts = [], []
        for fit, bad in zip(fits, other.tolist(), strict=True):
            rule = ranked[int(fit.argmax())] if fit.any() else None
            names.append(rule.name if rule else None)
            verdicts.append(rule.verdict if rule else BLOCK if bad else ALLOW)
        columns = [[h for h, _, _ in parts], [p for _, p, _ in parts], names, verdicts]
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "path", "rule", "verdict"])

    found = pages.select("page_id", decide("url").alias("_d"))
    return found.select("page_id", "_d.host", "_d.path", "_d.rule", "_d.verdict")
