"""Divergence audit, periodic runs and shards against plain brute force, and in pieces as small as they can be."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import DOCUMENTS, awkward, documents, empty
from weirflow.llm import divergence, periodic, sharding
from weirflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sha(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def plain_runs(words, times=4, least=6):
    found = {}
    for q in range(1, len(words) // times + 1):
        start = 0
        while start + q < len(words):
            end = start + q
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(times * q, least):
                found.setdefault((start, end), q)
            start = max(start + 1, end - q + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words):
    gone = set()
    found = plain_runs(words)
    for start, length, q in found:
        gone.update(range(start + q, start + length))
    return found, " ".join(w for k, w in enumerate(words) if k not in gone)


repeated = st.builds(lambda unit, n: unit * n, st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 7))
word_lists = st.lists(st.one_of(repeated, st.lists(st.integers(0, 3), max_size=3)), max_size=6).map(lambda x: sum(x, []))


@settings(max_examples=150, deadline=None)
@given(st.lists(word_lists, min_size=1, max_size=4), st.sampled_from([(4, 6), (2, 1), (3, 5)]), st.sampled_from([1, 1 << 21]))
def test_runs_match_brute_force(texts, least, ranked):
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    numbers = np.array(sum(texts, []), np.int64)
    kept, periodic.RANKED_WORDS = periodic.RANKED_WORDS, ranked
    looked, periodic.LOOKED_UP = periodic.LOOKED_UP, 5
    try:
        found = periodic.runs(numbers, starts, *least)
    finally:
        periodic.RANKED_WORDS, periodic.LOOKED_UP = kept, looked
    assert [tuple(r) for r in found.tolist()] == [(t, *run) for t, words in enumerate(texts) for run in plain_runs(words, *least)]


@pytest.mark.parametrize("numbers, run", [(np.zeros(300_000, np.int64), (300_000, 1)), (np.arange(300_000) % 777, (300_000, 777))])
def test_runs_of_a_constant_and_a_periodic_long_text(numbers, run):
    assert periodic.runs(numbers, np.array([0, len(numbers)])).tolist() == [[0, 0, *run]]


def test_one_period_is_left_of_each_run(spark):
    texts = ["a b a b a b a b c", "x x x x x x\ny", "", None, " \t", "one two three", "q " * 10 + "a b " * 4, "  a  a\ta\va a a "]
    found = {r["doc_id"]: r for r in periodic.collapse(documents(spark, texts)).collect()}
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs, left = plain_collapse(words)
        assert [tuple(r) for r in found[k]["runs"]] == runs and found[k]["collapsed"] == left
        assert (found[k]["n_words"], found[k]["n_dropped"]) == (len(words), len(words) - len(left.split()))
    assert found[0]["collapsed"] == "a b c" and found[6]["collapsed"] == "q a b"


def test_periodic_query_matches_brute_force(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    found = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    periodic_texts = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if chosen == 0 and words:
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs, left = plain_collapse(words)
        row = found[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == expected
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row["collapsed_sha256"] == sha(left)
        periodic_texts += bool(runs)
    assert periodic_texts > 5


# Divergence audit


def plain_audit(rows, min_docs, top):
    """``rows``: (lang, source, text)."""
    counts, docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for la, s in groups if la == lang]

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            pairs = [(b, sum(abs(own[s][t] - own[b][t]) for t in kept)) for b in sources if b != s]
            terms = [(t, own[s][t] - whole[t]) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:last], 1)]
    return sorted(out)


def audited(docs, **settings):
    return sorted(map(tuple, divergence.audit(docs, **settings).collect()))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(11)
    words = ["Alpha", "beta", "été", "日本", "x1y", "don't", "Zoë", "ÉTÉ", "gamma", "of", "the"]
    rows = []
    for k in range(240):
        lang, source = rng.choice(["en", "de", "a\0b", None, ""]), rng.choice(["s", "t", "u", None])
        text = rng.choice([None, "", "...", " ".join(rng.choices(words, k=rng.randrange(1, 40)))])
        rows.append((k, text, lang, source, 0))
    rows += [(900, "only here", "fr", "alone", 0), (901, "Alpha " * 50_000, "en", "s", 0)]
    return rows, spark.createDataFrame(rows, DOCUMENTS)


@pytest.mark.parametrize("settings", [{}, {"block_entries": 3, "shards": 5, "fan_in": 3}])
def test_audit_matches_brute_force(mixed, settings, monkeypatch):
    rows, docs = mixed
    if settings:
        for name, small in (("PAGE_ENTRIES", 2), ("OPENED", 2), ("HELD", 3), ("CELLS", 8)):
            monkeypatch.setattr(divergence, name, small)
    expected = plain_audit([(lang, source, text) for _, text, lang, source, _ in rows], 4, 3)
    assert audited(docs, min_docs=4, top=3, **settings) == expected
    assert any(r[:2] == ("en", "") for r in expected) and any(r[2] == "term" for r in expected)


def test_pieces_of_a_long_text_are_whole(monkeypatch):
    text = ("Eins zwei3drei ÄÖ " * 500).encode()
    whole = [w for part in divergence._pieces(text) for w in part]
    monkeypatch.setattr(divergence, "_PIECE", 7)
    assert [w for part in divergence._pieces(text) for w in part] == whole and len(whole) == 2000


def test_merge_takes_every_term_once(monkeypatch):
    monkeypatch.setattr(divergence, "OPENED", 3)
    rng = random.Random(3)
    total, pages = collections.Counter(), []
    for _ in range(7):
        terms = sorted(rng.sample([b"%03d" % k for k in range(60)], 25))
        for at in range(0, 25, 4):
            part = terms[at : at + 4]
            counts = [rng.randrange(1, 9) for _ in part]
            total.update(dict(zip(part, counts)))
            pages.append(pa.table([part, [b"en"] * len(part), ["s"] * len(part), counts], schema=divergence.ENTRY))
    merged = [row for t in divergence.merged(sorted(pages, key=lambda p: p["term"][0].as_py())) for row in t.to_pylist()]
    assert len(merged) == len(total) and {r["term"]: r["n"] for r in merged} == dict(total)


# Shards


def dealt(docs, **settings):
    return sharding.shard(docs, **settings).select("doc.*", "size", "shard", "slot").collect()


def check_shards(rows, shards):
    largest = max(r["size"] for r in rows)
    bytes_in = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        bytes_in[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(bytes_in) <= set(range(shards))
    fair = sum(bytes_in.values()) / shards
    assert all(abs(bytes_in[k] - fair) <= largest for k in range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("range_bytes", [sharding.RANGE_BYTES, 900])
def test_shards_are_near_equal_and_in_key_order(spark, range_bytes):
    rng = random.Random(6)
    docs = documents(spark, [None, "", *("ä" * int(rng.paretovariate(0.9)) for _ in range(800)), "x" * 3000])
    rows = dealt(docs, shards=7, range_bytes=range_bytes)
    assert len(rows) == 803
    check_shards(rows, 7)
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 for r in rows)
    in_order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert in_order == sorted(in_order)


def test_equal_rows_are_cut_apart(spark):
    """One key, the null key and equal rows may hold everything."""
    same = spark.range(600).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    one = spark.range(300).select(F.lit(5).cast("bigint").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = dealt(same.union(one), shards=5, range_bytes=100)
    assert len(rows) == 900
    check_shards(rows, 5)


def test_ranges_are_bounded(spark):
    docs = documents(spark, ["w" * (k % 50) for k in range(2000)] + ["h" * 5000])
    order = F.struct(F.col("doc_id").alias("key"))
    placed, ranges = sharding.into_ranges(docs.select(order.alias("order"), sharding.record_size(F.col("text")).alias("size")), 1000)
    sized = placed.groupBy(*ranges).agg(F.sum("size").alias("n"), F.max("size").alias("m")).collect()
    assert len(ranges) > 2 and sum(r["n"] for r in sized) == sum(k % 50 + 8 for k in range(2000)) + 5008
    assert all(r["n"] - r["m"] <= 1000 for r in sized)


def test_written_shards_hold_their_slots(spark, tmp_path):
    docs = documents(spark, ["t" * k for k in range(100)])
    sharded = sharding.shard(docs, 4)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*docs.columns, "_slot", "shard"])
    assert sorted(map(tuple, back.select("doc_id", "shard", "_slot").collect())) == sorted(
        map(tuple, sharded.select("doc.doc_id", "shard", "slot").collect())
    )


# Awkward inputs


def test_awkward_inputs(spark):
    docs = awkward(spark)
    rows = dealt(docs.select("doc_id", "text", "start", "kept"), shards=3)
    assert len(rows) == docs.count()
    check_shards(rows, 3)
    collapsed = periodic.collapse(docs).collect()
    assert len(collapsed) == docs.count() and {r["n_words"] for r in collapsed if r["doc_id"] in (1, 2, 3)} == {0}
    plain = plain_audit([(r["lang"], r["source"], r["text"]) for r in docs.collect()], 1, 50)
    assert audited(docs, min_docs=1) == plain
    wide = docs.withColumns({c: F.lit(c) for c in ("doc", "size", "order", "shard", "slot", "runs", "term", "_range0", "_b", "p", "n", "z")})
    assert sharding.shard(wide, 3).count() == periodic.collapse(wide).count() == docs.count()
    assert audited(wide, min_docs=1) == plain


def test_empty_tables(spark):
    docs = empty(spark)
    assert sharding.shard(docs).count() == periodic.collapse(docs).count() == divergence.audit(docs).count() == 0
