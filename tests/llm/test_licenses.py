from __future__ import annotations

import pytest

from docketrank.llm import licenses


def scanned(docs):
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_phrases_and_spans(documents):
    apache = licenses.TEMPLATES["apache"][2]
    words = apache.split()
    gap = " ".join(words[:14] + ["really"] + words[14:])
    rows = [
        (1, "x MIT License, the mit-license y mit  LICENSE"),
        (2, "before " + apache.title() + ", after"),
        (3, gap),
        (4, " ".join(words[:8])),  # too little of it
        (5, " ".join(words[::-1])),
        (6, "GENERAL\nPUBLIC license"),
        (7, "Licensed under CC BY-NC 4.0."),
        (9, " ".join(words[:14] + words[15:])),  # a word less
        (8, "mit Ｌicense mit licensé"),
    ]
    found = scanned(documents(rows))
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"], found[1]["base_labels"]) == (3, 1, 7, "mit")
    assert (found[2]["labels"], found[2]["score"], found[2]["base_labels"]) == ("apache", 1.0, "")
    assert (found[3]["labels"], found[3]["n_spans"]) == ("apache", 1)
    assert found[9]["labels"] == "apache" and 0.75 <= found[9]["score"] < 1
    assert found[4]["labels"] == found[5]["labels"] == "" and found[4]["score"] == 0
    assert found[6]["base_labels"] == "gpl" and found[6]["score"] == licenses.PHRASE_SCORE
    assert found[7]["labels"] == "cc" and found[7]["n_base"] == 0
    assert found[8]["n_base"] == 0 and found[8]["n_words"] == 4


def test_every_template_is_found_and_kin_are_told_apart(documents):
    texts = [(label, text) for label, ts in licenses.TEMPLATES.items() for text in ts]
    found = scanned(documents([(i, f"Some words first: {text.title()}; and some behind.") for i, (_, text) in enumerate(texts)]))
    for i, (label, _) in enumerate(texts):
        assert label in found[i]["labels"].split(",") and found[i]["score"] == 1.0
        assert set(found[i]["labels"].split(",")) <= {label, "gpl"} or label == "gpl"
    notice = licenses.TEMPLATES["gpl"][1]
    kin = scanned(documents([(1, notice), (2, notice.replace("general", "affero general")), (3, "Licensed under CC BY-NC-SA 4.0")]))
    assert kin[1]["labels"] == "gpl" and "agpl" in kin[2]["labels"] and kin[3]["labels"] == "cc"


def test_two_copies_are_two_spans(documents):
    text = licenses.TEMPLATES["bsd"][0]
    docs = documents([(1, text + " and then many other words follow here " * 3 + text)])
    spans = licenses.spans(docs).orderBy("first_word").collect()
    assert [(s["label"], s["share"]) for s in spans] == [("bsd", 1.0)] * 2
    assert spans[0]["first_word"] == 0 and spans[0]["last_word"] == len(text.split()) - 1


def test_edge_rows(documents, edge_rows):
    rows = licenses.scan(documents(edge_rows)).collect()
    assert len(rows) == len(edge_rows)
    assert all(r["n_base"] == 0 and r["labels"] == "" and r["first_word"] is None for r in rows)
    assert licenses.scan(documents([]).limit(0)).count() == 0


@pytest.mark.parametrize("template", [t for ts in licenses.TEMPLATES.values() for t in ts])
def test_templates_are_plain_words(template):
    assert template == " ".join(template.lower().split()) and len(template.split()) >= licenses.GRAM
