from __future__ import annotations

import random
import re
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from docketrank.llm import pieces

TEXTS = [
    "a  b", " a", "a ", "\n", "a\nb", "\t", "  ", "ﬁ x", "Ａ z", "a\n\n  b", "   a    bbbbb", "<s> </s>", "日本語のテキスト", "𝒳 y",
    "a\x00b  c", "\x00", "a▁b ▁", " \n  \n\n x", "x" * 90 + " mississippi", "The quick brown fox's 1234 jumps.", "wi th 　",
]


@pytest.fixture(scope="module")
def model():
    return pieces.public_model()


def test_equals_the_library(documents, edge_rows, model):
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    bits = ["the ", "ing", "re", "é", " ", "\n", "z", "ß", "日", "12", "Ab"]
    random_texts = ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(60)]
    rows = [(100 + i, t) for i, t in enumerate(TEXTS + random_texts)] + [r for r in edge_rows if r[0] not in (5, 7)] + [(7, "long " * 3000)]
    docs = documents(rows)
    coded = pieces.encode(docs, model)
    texts = {r[0]: r[1] for r in rows}
    ids = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert ids == {k: sp.encode(t or "") for k, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in pieces.decode(coded, model).collect()} == {
        k: (t or "").replace(pieces.BLANK, " ") for k, t in texts.items()
    }


def test_runs_without_blanks(documents, model):
    """Words longer than a window, the lengths around it, and a run of 600,000 characters in seconds."""
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    lengths = [*range(pieces.WINDOW - 2, pieces.WINDOW + 3), 97, 98, 99, 500, 20_000]
    rows = [(n, "".join(rng.choices(letters, k=n))) for n in lengths for letters in ("ab", "theringaslo", "日本éa𝒳")]
    rows += [(n, "a" * n) for n in (65, 113, 4001)] + [(7, "".join(rng.choices("ACGTthe", k=600_000)))]
    coded = pieces.encode(documents([(i, t) for i, (_, t) in enumerate(rows)]), model)
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {i: sp.encode(t) for i, (_, t) in enumerate(rows)}


def test_many_groups_equal_one(documents, model, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "thing", "zz", "é"], k=20))) for i in range(60)] + [(90, None)] * 9
    one = pieces.encode(documents(rows), model).collect()
    monkeypatch.setattr(pieces, "GROUP_CHARS", 100)
    assert sorted(pieces.encode(documents(rows), model).collect()) == sorted(one)


def test_repeated_rows_and_empty_table(documents, model):
    coded = pieces.encode(documents([(5, "word"), (5, "word"), (None, "x")]), model).collect()
    assert len(coded) == 3
    assert pieces.encode(documents([]).limit(0), model).count() == 0


def test_viterbi_for_unigram_models(documents):
    """Against the best of all segmentations, on a small table with ties and a missing letter."""
    table = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -2.2, "ba": -2.75, "aba": -4.0}
    model = pieces.PieceModel("unigram", tuple((p, i + 300, s) for i, (p, s) in enumerate(table.items())), 3, 3)

    def best(word):
        if not word:
            return 0.0
        options = [table[word[:k]] + best(word[k:]) for k in range(1, 4) if word[:k] in table and len(word) >= k]
        return max([*options, min(table.values()) - pieces.UNKNOWN_BELOW + best(word[1:])])

    score = {i + 300: s for i, s in enumerate(table.values())}
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abc ", k=rng.randrange(1, 9)))) for i in range(40)]
    best = cache(best)
    rows += [(90, "".join(rng.choices("abc", k=300)))]
    coded = pieces.encode(documents(rows), model)
    unknown = min(table.values()) - pieces.UNKNOWN_BELOW
    texts = dict(rows)
    for r in coded.collect():
        got = sum(score.get(i, unknown) for i in r["ids"])
        assert got == pytest.approx(best("▁" + texts[r["doc_id"]].replace(" ", "▁")))
    assert {r["doc_id"]: r["text"] for r in pieces.decode(coded, model).collect()} == texts


def test_words_that_share_a_hash(model):
    """Edges of two words under one hash: each word gets those that spell its own text."""
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ranks, words = pieces._ranks(model), ["▁the", "thing", "ring", "xing"]
    table = {piece: ranks[score] << 24 | i for piece, i, score in model.pieces}
    edges = [
        (a * pieces.WINDOW + k) << 48 | table[word[a : a + k]]
        for word in words
        for a in range(len(word))
        for k in range(2, len(word) - a + 1)
        if word[a : a + k] in table
    ]
    coded = pa.table({"hash": pa.array([7] * len(edges), "int64"), "edge": edges})
    group = pieces._Parts(coded, model)
    group._rows = lambda names: np.zeros(len(names), "int64")
    flat, ends = group.ids(pa.array(words, pa.large_string()))
    whole = {"▁the": "the", "thing": "\nthing", "ring": "\nring", "xing": "\nxing"}
    for word, begin, end in zip(words, [0, *ends[:-1]], ends):
        said = sp.encode(whole[word])
        assert flat[begin:end].tolist() == (said if word[0] == pieces.BLANK else said[2:])


def test_cuts_agree(documents, model):
    """The column and the column's twin in Arrow cut alike, and as the pattern says."""
    rng = random.Random(4)
    texts = ["".join(rng.choices([" ", "\n", "a", "b", "▁", ",", "\x00"], weights=[4, 2, 4, 2, 1, 2, x], k=rng.randrange(25))) for x in (0, 0.3) for _ in range(150)]
    words, sizes = pieces._cut(pa.array(texts))
    ends = np.cumsum(sizes).tolist()
    mine = [words[a:b].to_pylist() for a, b in zip([0, *ends[:-1]], ends)]
    pattern = [re.findall(pieces.WORD, "▁" + t.replace(" ", "▁")) if t else [] for t in texts]
    assert mine == pattern
    rows = documents(list(enumerate(texts))).select("doc_id", F.filter(pieces.words_of(F.col("text")), lambda w: w != "").alias("w"))
    assert {r["doc_id"]: r["w"] for r in rows.collect()} == dict(enumerate(pattern))


def test_nothing_is_shuffled_sorted_or_gathered(documents, model):
    """What a task holds follows from its slices: no sort or hash table has the edges of many groups."""
    plan = pieces.encode(documents([(1, "the thing")]), model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Sort|Aggregate|CoGroup|hashpartitioning|rangepartitioning", plan)
    assert plan.count("MapInArrow") == 2 and "BroadcastHashJoin" in plan


def test_parts_known_and_forgotten(documents, model, monkeypatch):
    """Slices of a few rows in one task: later ones use the parts of earlier ones, windows too, until all are forgotten."""
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    words = ["the", "thing", "ring", "x" * 70 + "the", "é", "日本", "12", "mississippi", "\n", "a\x00b"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(9)))) for i in range(80)]
    for known in (0, 5, 1000):
        monkeypatch.setattr(pieces, "GROUP_CHARS", 90)
        monkeypatch.setattr(pieces, "KNOWN_PARTS", known)
        coded = pieces.encode(documents(rows).coalesce(1), model).collect()
        assert {r["doc_id"]: r["ids"] for r in coded} == {i: sp.encode(text) for i, text in rows}


def test_rows_out_of_order_fail(model):
    """Ids would be wrong if the join gave rows in another order, or twice."""
    number = pieces._numbered(model, 1000, 1000)
    made = [b for b in number(iter([pa.record_batch({"doc_id": [1, 2], "text": ["1", "2"]})])) if len(b)]
    none = {"hash": pa.nulls(2, "int64"), "edge": pa.nulls(2, "int64")}
    rows = [b.drop_columns(["word"]) for b in made if b["kind"][0].as_py() != pieces.EDGES]
    rows = [pa.record_batch({c: b[c] for c in b.schema.names} | {k: v[: len(b)] for k, v in none.items()}) for b in rows]
    assert sum(len(b) for b in pieces._spoken(model)(iter(rows))) == 2
    for wrong in ([*rows, rows[0]], [*rows, rows[-1]], [rows[0], *rows]):
        with pytest.raises(RuntimeError, match="order"):
            list(pieces._spoken(model)(iter(wrong)))
