"""The pipeline's stages over the smallest tables."""

import numpy as np

import corpus_pipeline
from weirflow.llm import common, language
from weirflow.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = table(spark, SF, "documents")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    assert counts[2] == counts[1]  # lines go, documents stay
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == counts[-1]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_a_worker_holds_what_one_operator_keeps():
    common.release()
    first = common.held(("a", 1), lambda: [1])
    assert common.held(("a", 1), lambda: [2]) is first
    assert common.held(("b",), lambda: [3]) == [3]
    assert common.held(("a", 1), lambda: [4]) == [4]
    common.release()
    assert not common._held


def test_trigram_products_come_in_slices(monkeypatch):
    texts = ["some words of a text", "autre texte, d'autres mots", "", "x" * 50]
    whole = language.Profiles(64, 1).bundles(texts, np.arange(4), 4)
    monkeypatch.setattr(language, "_TRIGRAMS_AT_ONCE", 3)
    assert (language.Profiles(64, 1).bundles(texts, np.arange(4), 4) == whole).all() and whole[0].any()


def test_packing_holds_few_words_and_lets_go_of_them():
    from weirflow.llm import packing, tokens

    assert corpus_pipeline.WORD_BYTES < tokens.GENERATION_BYTES
    common.held(("words",), dict)
    lists = packing._cut(packing.plan(np.array([5])), np.array([0]), np.array([0]), np.array([5]))
    assert not common._held
    assert lists.to_pylist() == [[{"start": 0, "length": 5, "sequence_id": 0, "offset": 0}]]
