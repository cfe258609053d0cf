"""Ranks of suffixes: the same in every shard, and exact against a plain count."""

import random

import numpy as np

from weirflow.llm import suffix_dedup


def test_groups_are_the_same_in_all_shards():
    zeros, ones = np.zeros(1, np.int64), np.ones(1, np.int64)
    a = suffix_dedup.repeated_suffixes([b"xx" + b"k" * 3 + b"the same string"], zeros, zeros, ones, 12)
    b = suffix_dedup.repeated_suffixes([b"the same string, and more"], zeros, zeros, ones, 12)
    assert a[3][a[1] == 5] == b[3][b[1] == 0]
    assert len(set(a[3].tolist() + b[3].tolist())) == len(a[3]) + len(b[3]) - 4


def test_ranks_hold_over_the_edge_of_a_slice(monkeypatch):
    rng = random.Random(7)
    contexts = [bytes(rng.choices(b"ab", k=rng.randrange(5, 60))) for _ in range(80)] + [b"", b"ab"]
    text, weight = np.arange(len(contexts)), np.ones(len(contexts), np.int64)
    for length in (5, 13, 20):
        for size in (7, 1 << 16):
            monkeypatch.setattr(suffix_dedup, "_RANKED_AT_ONCE", size)
            owner, place, repeated, group = suffix_dedup.repeated_suffixes(contexts, text, 0 * text, weight, length)
            strings = [contexts[k][p : p + length] for k, p in zip(owner.tolist(), place.tolist())]
            assert len(strings) == sum(max(0, len(c) - length + 1) for c in contexts)
            assert repeated.tolist() == [strings.count(s) > 1 for s in strings]
            assert len(set(zip(strings, group.tolist()))) == len(set(strings)) == len(set(group.tolist()))
