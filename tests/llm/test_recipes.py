from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docketrank.llm import recipes

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    return SPACE.sub(" ", text or "")


def wanted(rows):
    """(doc_id, keep_id, group_size, sha256) of every row, by comparing whole texts."""
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for doc_id in ids:
            out.append((doc_id, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=str)


def texts(rng):
    rows = []
    for base in range(25):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 5, 200, 900]))]
        for copy in range(rng.choice([1, 1, 2, 6])):
            gaps = [rng.choice([" ", "  ", "\n", "\t ", "\r\n", "\x0b"]) for _ in words]
            changed = list(words)
            if copy > 3:
                changed[rng.randrange(len(words))] = "other"
            rows.append((len(rows), "".join(a + b for a, b in zip(changed, gaps, strict=True)) + rng.choice(["", "end"])))
    return rows


WEAK = {
    "xxhash64": F.xxhash64,
    "one for all": lambda chunk: F.lit(1).cast("long") + F.length(chunk) * 0,
    "length": lambda chunk: F.length(chunk).cast("long"),
}


@pytest.mark.parametrize("chunk_hash", WEAK)
def test_against_whole_texts(documents, edge_rows, chunk_hash):
    """Also with hashes under which chunks clash: those are told apart by their texts."""
    rng = random.Random(4)
    rows = [(i + 100, t) for i, t in texts(rng)] + edge_rows
    out = recipes.exact_duplicates(documents(rows), chunk_hash=WEAK[chunk_hash])
    assert found(out) == wanted(rows)


def test_one_row_of_each_text_is_kept(documents):
    rows = [(1, "a  b"), (1, "a b"), (1, "a b"), (2, "a\nb"), (None, "a b"), (None, "x"), (None, "x"), (3, None), (4, ""), (5, " ")]
    out = recipes.exact_duplicates(documents(rows)).collect()
    kept = [(r["doc_id"], r["group_size"]) for r in out if r["kept"]]
    assert sorted(kept, key=str) == sorted([(1, 5), (None, 2), (3, 2), (5, 1)], key=str)


def test_chunks_are_the_text_and_follow_its_content(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    cases = {
        "long": " ".join(words),
        "one word in front": "new " + " ".join(words),
        "one word inside": " ".join([*words[:2000], "new", *words[2000:]]),
        "same word": "same " * 5000,
        "no blank": "é日" * 40_000,
        "blanks": " a b ",
    }
    df = spark.createDataFrame(list(cases.items()), "name string, t string")
    cut = {r["name"]: r["c"] for r in df.select("name", recipes.chunks_of(recipes.normalised(F.col("t"))).alias("c")).collect()}
    assert all("".join(cut[name]) == plain(text) for name, text in cases.items())
    assert all(len(c.split()) <= recipes.MOST_TOKENS for chunks in cut.values() for c in chunks)
    assert 20 < len(cut["long"]) < 200
    for name in ("one word in front", "one word inside"):
        assert len(set(cut[name]) - set(cut["long"])) <= 3


def test_empty_table(documents):
    assert recipes.exact_duplicates(documents([]).limit(0)).count() == 0


def test_texts_move_once(spark, tables, plan):
    """No shuffle after the recipes carries a text, and no Python runs."""
    text = plan(recipes.exact_duplicates(spark.read.parquet(f"{tables}/documents.parquet")))
    assert "plain" not in text and "chunk" not in text and "Python" not in text and "Arrow" not in text
