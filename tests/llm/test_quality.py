from __future__ import annotations

import random
import re

from docketrank.llm import quality


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def random_text(rng):
    words = ["a", "bé", "c#", "d", "日本", "f|g"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t ", "  ", "\r\n"]) for _ in range(rng.randrange(80)))


def judged(docs):
    rows = quality.judge(docs).collect()
    return [(r["row"]["doc_id"], r) for r in rows]


def test_measures_equal_brute_force(documents):
    rng = random.Random(1)
    rows = [(i, random_text(rng)) for i in range(120)]
    rows += [(500, "one two three four five six seven eight " * 5), (501, "x " * 8), (502, "x " * 9)]
    texts = dict(rows)
    for doc_id, r in judged(documents(rows)):
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == measures(texts[doc_id]), texts[doc_id]
        n, _, _, _, repeated = got
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert not (r["kept"] and r["base_failed"])


def test_edge_rows(documents, edge_rows):
    found = judged(documents(edge_rows))
    assert len(found) == len(edge_rows)
    assert all(r["base_failed"] and not r["kept"] for _, r in found)  # none has 20 words without repeats


def test_empty_table(documents):
    assert quality.judge(documents([]).limit(0)).count() == 0
    assert quality.keep_good(documents([]).limit(0)).columns[:2] == ["doc_id", "text"]


def test_thresholds_follow_the_group(documents):
    """Symbols that are usual in one source are a fault in another; clean texts stay."""
    rng = random.Random(2)

    def text(symbols):
        return " ".join(f"w{rng.randrange(10**6)}" + "#" * (rng.random() < symbols) for _ in range(60))

    rows = [(i, text(0.0), "en", "plain") for i in range(40)] + [(100, text(0.6), "en", "plain")]
    rows += [(200 + i, text(0.6), "en", "code") for i in range(40)]
    kept = {r["doc_id"] for r in quality.keep_good(documents(rows)).collect()}
    assert 100 not in kept and set(range(40)) <= kept and {200 + i for i in range(40)} <= kept


def test_columns_stay(documents):
    docs = documents([(1, "a b c")])
    assert quality.keep_good(docs).columns == docs.columns
