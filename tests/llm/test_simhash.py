from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from docketrank.llm import simhash
from tests.llm.test_graph import components_of


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def near(values):
    rng = random.Random(5)
    out = []
    for value in values:
        for _ in range(12):
            other = value
            for bit in rng.sample(range(64), rng.randrange(0, 7)):
                other ^= 1 << bit
            out.append(other)
    return out


def test_fingerprint_equals_its_definition():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Aé", "b", "ZZ", "dd"]) for _ in range(n)) for n in (0, 1, 3, 4, 5, 9, 40)]
    for text in [*texts, None, "  a\x0bb \r\n c d  e f g"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank():
    code = np.arange(1024, dtype=np.uint64)
    assert np.array_equal(simhash.gray_rank(code ^ (code >> np.uint64(1))), code)


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_links_of_a_bucket(seed):
    rng = np.random.default_rng(seed)
    base = [int(x) for x in rng.integers(0, 2**63, 5)]
    values = np.array(sorted(set(near(base))), np.uint64)
    buckets = np.sort(rng.integers(0, 3, len(values)))
    index = simhash.GrayIndex(values, buckets)
    a, b = index.links(np.arange(len(values)), 4)
    found = {tuple(sorted((int(index.order[x]), int(index.order[y])))) for x, y in zip(a, b, strict=True)}
    wanted = {
        (i, j)
        for i in range(len(values))
        for j in range(i + 1, len(values))
        if buckets[i] == buckets[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 4
    }
    assert found == wanted


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(9)
    values = sorted(set(near([rng.getrandbits(64) for _ in range(12)])))
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "rep long, fp long")).collect()
    wanted = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    assert components_of([tuple(r) for r in links]) == components_of(wanted)
    assert all((values[r["a"]] ^ values[r["b"]]).bit_count() >= 1 for r in links)


def test_documents_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {k: plain_fingerprint(v) & (2**64 - 1) for k, v in texts.items()}
    ids = sorted(prints)
    heads = components_of([(a, b) for a in ids for b in ids if b < a and (prints[a] ^ prints[b]).bit_count() <= 4])
    found = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {k: heads.get(k, k) for k in ids}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k in ids if heads.get(k, k) == k]


def test_edge_rows(documents, edge_rows):
    docs = documents(edge_rows)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[k]["component_id"] for k in (1, 2, 3, 6)} == {1} and by_id[2]["fp"] == 0
    assert by_id[5]["component_id"] == 4 and by_id[None]["component_id"] is None
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 4, 7, 8] and kept.count(None) == 1


def test_one_of_repeated_ids_stays(documents):
    docs = documents([(1, "a b c"), (1, "a b c"), (2, "x y"), (2, "other words here")])
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == [1, 2]


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([]).limit(0)).count() == 0
    assert simhash.keep_one(documents([]).limit(0)).count() == 0
