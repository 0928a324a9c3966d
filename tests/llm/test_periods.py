from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docketrank.llm import periods, queries


def plain_runs(words):
    """All runs (start, length, period) by looking at every period and place."""
    n, best = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            best.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in best.items() if n >= max(6, 4 * q))


def runs_of(documents):
    """Runs of each document of words, all looked at together."""
    numbers = {}
    flat = [numbers.setdefault(w, len(numbers)) for d in documents for w in d]
    doc, *found = periods.find_runs(np.array(flat, np.int64), np.array([len(d) for d in documents], np.int64))
    out = [[] for _ in documents]
    for d, *run in zip(doc.tolist(), *(x.tolist() for x in found), strict=True):
        out[d].append(tuple(run))
    return out


def planted(rng, alphabet):
    words = [rng.choice(alphabet) for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(4)):
        unit = [rng.choice(alphabet) for _ in range(rng.randrange(1, 30))]
        size = rng.randrange(1, 8 * len(unit))
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * (size // len(unit) + 1))[:size]
    return words


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc", [f"w{i}" for i in range(500)]])
@pytest.mark.parametrize("at_once", [periods.PLACES_AT_ONCE, 7])
def test_against_plain_search(alphabet, at_once, monkeypatch):
    monkeypatch.setattr(periods, "PLACES_AT_ONCE", at_once)
    rng = random.Random(len(alphabet))
    documents = [planted(rng, alphabet) for _ in range(60)] + [[], ["a"] * 6, ["a"] * 5, ["a", "b"] * 4, ["a", "b"] * 3]
    assert runs_of(documents) == [plain_runs(d) for d in documents]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=70), max_size=4))
def test_any_short_documents(documents):
    assert runs_of(documents) == [plain_runs(d) for d in documents]


def test_copies_and_nested_runs():
    """Copies side by side don't extend each other, and long periods hold short ones."""
    unit = ["x"] * 8 + ["y"] + ["a", "b"] * 5
    documents = [unit * 6] * 3 + [unit * 50]
    found = runs_of(documents)
    assert found == [plain_runs(d) for d in documents]
    assert (0, len(unit) * 50, len(unit)) in found[3]


def test_cover_reaches_every_pair():
    for a in range(periods.COVER):
        for b in range(periods.COVER):
            d = periods._SHIFT[a, b]
            assert {(a + d) % periods.COVER, (b + d) % periods.COVER} <= set(periods.MARKS)


def test_long_texts_take_seconds():
    rng = random.Random(8)
    words = [f"w{rng.randrange(3000)}" for _ in range(200_000)]
    words[50_000:150_000] = (words[:997] * 101)[:100_000]
    (found,) = runs_of([words])
    assert [r for r in found if r[2] == 997][0][1] >= 100_000
    assert runs_of([["same"] * 300_000]) == [[(0, 300_000, 1)]]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (doc_id, len(runs), *best, milli, digest(listed), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_plain_search(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, tables).collect()}
    small = [r for r in docs.collect() if len(r["text"].split()) <= 600 or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
    assert len(found) == docs.count() and len(small) > 100
    assert all(found[r["doc_id"]] == wanted(r["doc_id"], r["text"]) for r in small)
    assert sum(found[r["doc_id"]][1] > 0 for r in small) > 10


def test_edge_rows(documents, edge_rows):
    rows = [r for r in edge_rows if r[0] != 7] + [(70, "tick tock " * 400), (30, "a b\x0bc a b c"), (31, "é" * 50_000)]
    found = sorted((tuple(r) for r in queries.run_rows(documents(rows)).collect()), key=str)
    assert found == sorted((wanted(r[0], r[1]) for r in rows), key=str)


def test_one_word_many_times(documents):
    (row,) = queries.run_rows(documents([(7, "long " * 60_000)])).collect()
    assert (row["n_runs"], row["start"], row["period"], row["length"]) == (1, 0, 1, 60_000)


def test_empty_table(documents):
    assert queries.run_rows(documents([]).limit(0)).count() == 0
