from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from docketrank.llm import manifest, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def roll(nodes):
    """The top of a tree over nodes, and each node's (left, right) siblings level by level."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for i in run:
                step = ("".join(nodes[run.start : i]), "".join(nodes[i + 1 : run.stop]))
                for one in under[i]:
                    paths[one].append(step)
        under = [[one for i in run for one in under[i]] for run in runs]
        nodes = [sha(*nodes[run.start : run.stop]) for run in runs]
    return nodes[0], paths


def wanted(rows, spoil):
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root) of a table, by plain loops."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        ranked = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf([r[c] for c in COLUMNS])))
        trees[source] = (ranked, *roll([leaf([r[c] for c in COLUMNS]) for r in ranked]))
    root, upper = roll([trees[s][1] for s in order])
    out = []
    for at, source in enumerate(order):
        ranked, subroot, paths = trees[source]
        for row, path in zip(ranked, paths, strict=True):
            steps = path + upper[at]
            node = leaf([spoil(row) if c == "text" else row[c] for c in COLUMNS])
            for left, right in steps:
                node = sha(left, node, right)
            proof = sha(*(left + right for left, right in steps))
            out.append((row["doc_id"], leaf([row[c] for c in COLUMNS]), subroot, root, proof, node))
    return out


def lowered(row):
    ascii_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
    return row["text"].translate(ascii_lower) if chosen and row["text"] is not None else row["text"]


def found(df):
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in df.collect()]


def check(docs, rows):
    out = queries.manifest_rows(docs)
    assert sorted(found(out), key=str) == sorted(wanted(rows, lowered), key=str)
    for r in out.collect():
        assert r["verified"] == (r["root"] == r["folded_root"])
    return out


def table(documents, sizes):
    rows, at = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((at * 7919 % 10007, f"Text {at} É" if at % 11 else None, "en" if at % 5 else None, source))
            at += 1
    return documents(rows)


@pytest.mark.parametrize("block_levels", [3, 1])
def test_trees_of_many_heights(documents, monkeypatch, block_levels):
    """Runs that are full, short and of one; several levels of blocks; sources in the order of their bytes."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(manifest, "BLOCK", 16**block_levels)
    sizes = {None: 3, "": 1, "Z": 2, "a": 16, "b": 17, "é": 256, "ｆ": 257, "𝒳": 290, **{f"s{i}": 1 for i in range(20)}}
    docs = table(documents, sizes)
    out = check(docs, [r.asDict() for r in docs.collect()])
    assert 0 < out.where("NOT verified").count() < out.count() / 3


def test_one_large_source(spark):
    """A source of more than one block, its rows in random order over tasks."""
    n = 3 * manifest.BLOCK + 100
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("T"), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 1000 == 0, "x").otherwise("hot").alias("source"), F.lit(5).cast("long").alias("n_chars"),
    ).orderBy(F.xxhash64("doc_id"))
    check(docs, [r.asDict() for r in docs.collect()])


def test_edge_rows(documents, edge_rows):
    docs = documents(edge_rows)
    check(docs, [r.asDict() for r in docs.select(*COLUMNS).collect()])


def test_one_row_and_none(documents):
    only = documents([(1, "A")])
    row = queries.manifest_rows(only).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")
    assert queries.manifest_rows(documents([]).limit(0)).count() == 0


def test_only_digests_move(spark, tables, plan):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert "text#" not in plan(queries.manifest_rows(docs))
