from __future__ import annotations

import numpy as np
import pytest

from docketrank.llm import embeddings
from tests.llm.test_graph import components_of

SCHEMA = "vec_id long, embedding array<float>, label int, unit int, shard string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    usable = []
    for vec_id, v, label in rows:
        if v is None or label is None or any(x is None for x in v):
            continue
        v = np.array(v, np.float32).astype(float)
        if len(v) and np.isfinite(v).all() and np.linalg.norm(v) > 0:
            usable.append((vec_id, v / np.linalg.norm(v), label))
    links = [
        (a[0], b[0]) for i, a in enumerate(usable) for b in usable[:i] if a[2] == b[2] and a[1] @ b[1] >= 0.98
    ]
    heads, counts = components_of(links), {}
    for a, b in links:
        counts[a], counts[b] = counts.get(a, 0) + 1, counts.get(b, 0) + 1
    return {r[0]: (counts.get(r[0], 0), heads.get(r[0], r[0])) for r in rows}


def families(seed, n_families, size, dim=16, spread=0.06, labels=2):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(n_families):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, size))):
            v = centre + rng.normal(size=dim) * spread * np.linalg.norm(centre) / np.sqrt(dim) * rng.random() * 2
            rows.append((len(rows), [float(np.float32(x)) for x in v], f % labels))
    return rows


@pytest.mark.parametrize("block", [embeddings.BLOCK, 40])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = families(1, 50, 12)
    rows += [(10_000 + i, rows[3][1], rows[3][2]) for i in range(5)]  # copies
    found, audit = embeddings.near_duplicates(table(spark, rows))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == brute(rows)
    counts = audit.first()
    assert counts["found"] >= 0.9 * counts["links"]


def test_many_shards_lose_no_link(spark, monkeypatch):
    """Several dozen centres over vectors without clusters, and a margin to begin with that is too small."""
    monkeypatch.setattr(embeddings, "BLOCK", 60)
    monkeypatch.setattr(embeddings, "MARGIN", 0.0)
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(600):
        centre = rng.normal(size=64)
        for _ in range(2):
            v = centre + rng.normal(size=64) * 0.09
            rows.append((len(rows), [float(np.float32(x)) for x in v], 1))
    found, audit = embeddings.near_duplicates(table(spark, rows))
    got = {r["vec_id"]: r["n_links"] for r in found.collect()}
    wanted = {k: n for k, (n, _) in brute(rows).items()}
    counts = audit.first()
    assert -(-2 * len(rows) // 60) >= 36 and counts["links"] > 500
    assert counts["found"] >= 0.99 * counts["links"]
    assert all(got[k] <= wanted[k] for k in wanted) and sum(got.values()) >= 0.99 * sum(wanted.values())


def test_recall_on_the_table(spark, tables):
    df = spark.read.parquet(f"{tables}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    found, _ = embeddings.near_duplicates(df)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == brute(rows)


def test_edge_rows(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (1, v, 1), (2, [2.0, 0.0, 0.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [float("nan"), 1.0, 0.0], 1), (9, [None, 1.0, 0.0], 1), (10, w, 1), (11, [float("inf"), 0.0, 0.0], 1), (12, v, 1),
    ]
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(table(spark, rows))[0].collect()}
    assert {k: (r["n_links"], r["component_id"]) for k, r in found.items()} == {
        **{k: (0, k) for k in range(1, 13)}, 1: (2, 1), 2: (2, 1), 12: (2, 1)
    }
    assert [k for k, r in found.items() if not r["kept"]] == [2, 12] or {k for k, r in found.items() if not r["kept"]} == {2, 12}


def test_empty_table(spark):
    found, audit = embeddings.near_duplicates(table(spark, []).limit(0))
    assert found.count() == 0 and audit.first()["links"] == 0


def test_pruned_graph_is_searchable():
    rng = np.random.default_rng(2)
    units = rng.normal(size=(400, 24))
    units[200:] = units[:200] + 0.02 * rng.normal(size=(200, 24))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    graph = embeddings.build_graph(units)
    assert max(map(len, graph)) <= 2 * embeddings.DEGREE
    table_ = np.full((400, 2 * embeddings.DEGREE), -1)
    for i, x in enumerate(graph):
        table_[i, : len(x)] = x
    q, v, links, met = embeddings.audited_search(units, table_, units, np.arange(400))
    assert met >= 0.99 * links and links >= 800
