"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import BENCHMARK, awkward, documents, empty
from weirflow.llm import (
    contamination,
    language,
    line_dedup,
    packing,
    passage_dedup,
    quality,
    simhash,
    suffix_dedup,
    token_files,
    url_rules,
)
from weirflow.llm.common import stored

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def bench(spark):
    return spark.createDataFrame([(1, "no id"), (None, "word1 word2"), (2, None), (3, "...")], BENCHMARK)


PER_ROW = {
    "lines": lambda spark, docs: line_dedup.without_repeated_lines(docs).select("doc.doc_id", "n_lines", "n_removed", "doc.text"),
    "windows": lambda spark, docs: contamination.scan(docs, bench(spark), with_text=True),
    "windows by join": lambda spark, docs: contamination.scan(docs, bench(spark), max_windows=0, with_text=True),
    "passages": lambda spark, docs: passage_dedup.remove_passages(docs),
    "quality": lambda spark, docs: quality.judge(docs),
    "language": lambda spark, docs: language.identify(docs, docs),
    "suffixes": lambda spark, docs: suffix_dedup.remove_repeats(docs, with_bytes=True),
    "tokens": lambda spark, docs: token_files.read(stored(token_files.segments(docs, TOKENS)), with_ids=True),
    "near copies": lambda spark, docs: simhash.near_duplicates(docs),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    docs = awkward(spark)
    found = PER_ROW[name](spark, docs).toPandas()
    assert len(found) == docs.count()
    assert found["doc_id"].isna().sum() == 1 and (found["doc_id"] == 5).sum() == 2
    twins = found[found["doc_id"] == 5].drop(columns=["start"], errors="ignore")
    assert len({repr(t) for t in twins.itertuples(index=False)}) == 1


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, empty(spark)).count() == 0


STAGES = {
    "language": language.keep_recognised,
    "lines": line_dedup.dedup_lines,
    "near copies": simhash.keep_one,
    "windows": lambda docs: contamination.keep_clean(docs, bench(docs.sparkSession)),
}
# What the language stage keeps of so few texts depends on what it could learn; never one without a letter.
KEPT = {"language": {1, 2, 3, 4, 5}, "lines": {8}, "near copies": {5}, "windows": {7}}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(spark, name):
    docs = awkward(spark)
    out = STAGES[name](docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.count() in KEPT[name]
    assert out.where("fingerprint != 'fingerprint' or _found != '_found' or _lines != '_lines'").count() == 0
    assert STAGES[name](empty(spark)).count() == 0


def test_packing(spark):
    docs = awkward(spark)
    out = packing.pack(docs, TOKENS).toPandas()
    assert out.groupby(["doc_id", "start"], dropna=False).size().max() == 2  # the repeated row
    assert out["length"].sum() == sum(r["n"] for r in packing.encoded(docs, TOKENS, 1, None, 3).collect())
    assert packing.pack(empty(spark), TOKENS).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Net?x=/"), (None, "x://b.NET/" + "y" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn("_d", F.lit(2))
    out = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge(pages, [url_rules.Rule("block", "net", "/")], []).collect()}
    assert out[1] == out[2] == out[3] == out[4] == ("", "", None, "allow")
    assert out[5] == ("a.net", "", None, "allow")
    assert out[None][0] == "b.net" and out[None][2:] == ("net/", "block")
    assert url_rules.judge(pages.limit(0), [], []).count() == 0


def test_near_copies_keep_one_row_of_repeated_rows(spark):
    out = simhash.keep_one(awkward(spark)).toPandas()
    assert (out["doc_id"] == 5).sum() == 1 and set(out["doc_id"].dropna()) == {1, 4, 5, 6}


def test_same_id_with_other_text(spark):
    docs = documents(spark, ["one two three four five six", "quite another text in this row"]).withColumn("doc_id", F.lit(9))
    assert simhash.keep_one(docs).count() == 2
    assert line_dedup.dedup_lines(docs).where("text = ''").count() == 0
