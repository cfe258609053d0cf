"""What a word and a piece cost: marks behind words, the cut into pieces, and the cache sizes of the encoder."""

import numpy as np

from tests.llm.helpers import documents
from weirflow.llm import packing, tokens
from weirflow.llm.queries import tokenizer_path


def test_marks_behind_a_word_are_one_piece():
    known = tokens.Encoder(tokenizer_path())
    text = "word word$$$ été%%% it's l'eau, don't'. (x) a.b... 12!! _ $ -- x' 'x q's!"
    whole = known.plain([text])[0]
    assert known.encode([text, text]) == [whole, whole]
    asked = []
    plain, known.plain = known.plain, lambda texts: asked.append(texts) or plain(texts)
    known.encode(["word another$$$ others$$$ été$$$"])
    assert all(t == ["$$$"] for t in asked)  # the rest goes to the model, without a search for pieces


def test_generations_of_words_give_the_same_ids():
    text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(3000))
    few, many = tokens.Encoder(tokenizer_path(), 1000), tokens.Encoder(tokenizer_path())
    assert [few.encode([text]) for _ in range(3)] == [many.encode([text])] * 3


def test_ids_do_not_pass_through_python_again(spark, capsys):
    docs = documents(spark, ["one two three", None, "four " * 3000])
    out = packing.pack(docs, tokenizer_path())
    out.explain()
    asked = [line for line in capsys.readouterr().out.splitlines() if "Python" in line or "InArrow" in line]
    assert asked and not any("ids" in line.split("[cut(")[1].split(")")[0] if "[cut(" in line else "MapInArrow" in line for line in asked)
    rows = sorted((r["doc_id"], r["start"], r["length"]) for r in out.collect())
    assert sum(n for k, _, n in rows if k == 2) == out.where("doc_id = 2").first()["doc_tokens"]


def test_pieces_go_on_from_phase_to_phase():
    phases = packing.plan(np.array([300_000, 40, 1]))
    start = np.arange(0, 300_000, 999)
    end = np.minimum(start + 999, 300_000)
    found = np.concatenate([np.stack(x) for x in packing._pieces(phases, 0, start, end)], axis=1)
    each = [(k, *p) for k, (a, b) in enumerate(zip(start, end)) for p in packing.pieces(phases, 0, int(a), int(b - a))]
    assert found.T.tolist() == [list(p) for p in each]
    assert found[2].sum() == 300_000 and (found[4] >= 0).all() and (found[4] + found[2] <= packing.LENGTH).all()


def test_a_word_with_marks_costs_no_search_in_token_files(spark):
    from weirflow.llm import token_files

    texts = [f"some{chr(97 + k % 26)}{chr(97 + k // 26)}$$$ others%%%, (no) it's" for k in range(200)]
    files = token_files.segments(documents(spark, texts), tokenizer_path())
    read = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read(files, with_ids=True).collect()}
    plain = tokens.Encoder(tokenizer_path()).plain(texts)
    assert read == {k: [*np.frombuffer(x, "<u4").tolist(), 0] for k, x in enumerate(plain)}
