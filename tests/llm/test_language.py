from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketrank.llm import language
from docketrank.llm.queries import held_out, op4_language_id


@pytest.fixture(scope="module")
def model(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    return language.fit(docs.where(~held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark, tables):
    truth = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang", "n_chars")
    found = op4_language_id(spark, tables).where("held_out").join(truth, "doc_id").where("n_chars >= 30").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in found)
    assert len(found) > 40 and right >= 0.98 * len(found)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(0)
    sizes = [1, 4, 6, 0, 3]
    scores = rng.normal(0, 6, (sum(sizes), 3))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    label = language._viterbi(scores.copy(), owner, len(sizes))
    for text in range(len(sizes)):
        own = scores[owner == text]
        if not len(own):
            continue

        def value(path):
            changes = sum(a != b for a, b in zip(path, path[1:], strict=False))
            return sum(own[i, k] for i, k in enumerate(path)) - language.SWITCH_COST * changes

        best = max(value(p) for p in product(range(3), repeat=len(own)))
        assert value(label[owner == text].tolist()) == pytest.approx(best)


def test_mixed_text_has_spans(spark, tables, model):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("n_chars > 400")
    german, spanish = (docs.where(F.col("lang") == x).first()["text"][:400] for x in ("de", "es"))
    spans = language.label_texts([german + " " + spanish], model)[0][2]
    assert [s["lang"] for s in spans] == ["de", "es"]
    assert abs(spans[1]["start"] - 401) < 40


def test_scripts_narrow_candidates(documents):
    rows = [(i, "слово дело мир труд", "ru", "s") for i in range(5)] + [(10 + i, "some plain words", "en", "s") for i in range(5)]
    model = language.fit(documents(rows))
    assert model.langs == ("en", "ru")
    assert language.label_texts(["мир zzz qqq"], model)[0][2][0]["lang"] == "ru"
    assert language.label_texts(["文字"], model)[0][0] in model.langs  # no language has the script: none is excluded


def test_edge_rows(documents, edge_rows, model):
    docs = documents([*edge_rows, (20, "123 !?")])
    found = {r["row"]["doc_id"]: r["found"] for r in language.identify(docs, model).collect()}
    for doc_id in (1, 2, 3, 6, 20):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    assert found[4]["lang_pred"] in model.langs and 0 < found[7]["score"] <= 1
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and {1, 2, 3, 6, 20}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_no_training_rows(documents):
    model = language.fit(documents([(1, "abc", None, None), (2, None, "en", "s")]))
    assert language.label_texts(["abc"], model)[0][:2] == ("und", 0.0)
    assert language.identify(documents([]).limit(0), model).count() == 0
