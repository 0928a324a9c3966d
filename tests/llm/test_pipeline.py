from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docketrank.llm import packing, pii, simhash
from tests.llm.test_packing import checked
from tests.llm.test_quality import measures


@pytest.fixture(scope="module")
def stages(spark, tables):
    """What every stage returns, each given what the one before it kept."""
    docs = [spark.read.parquet(f"{tables}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.stored(stage(spark, docs[-1], tables)))
    return docs


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality_stage(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    for doc_id, row in before.items():
        n, _, _, _, repeated = measures(row["text"])
        if n < 20 or 100 * repeated > 30 * n:
            assert doc_id not in after
    assert all(after[k] == before[k] for k in after)
    assert len(after) > 0.7 * len(before)


def test_language_stage(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    assert set(after) == set(before)  # every text here is in one language
    assert sum(after[k]["lang"] == before[k]["lang"] for k in after) >= 0.98 * len(after)


def test_dedup_stage(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    prints = {k: simhash.fingerprint(r["text"]) & (2**64 - 1) for k, r in before.items()}
    for k in before:
        near = [o for o in prints if o != k and (prints[o] ^ prints[k]).bit_count() <= 4]
        if not near:
            assert k in after
        elif k in after:
            assert all(o not in after for o in near)
    assert all(after[k] == before[k] for k in after)


def test_mask_stage(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(after) == set(before)
    for k, row in after.items():
        assert not [s for s in pii.find_spans(row["text"]) if s.kind in pii.KINDS[:4]]
        assert row["n_chars"] == len(row["text"])
        if not pii.find_spans(before[k]["text"]):
            assert row == before[k]


def test_packing_stage(stages):
    checked(stages[5].collect(), {k: [r["text"]] for k, r in by_id(stages[4]).items()})


def test_run_and_registration(spark, tables, stages):
    assert corpus_pipeline.run(spark, tables).count() == stages[5].count()
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert set(entry.oracle_sql()) <= set(names)


def test_edge_tables(spark, tables, documents, edge_rows):
    docs = documents(edge_rows)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        out.count()
        if out.columns[:2] == ["doc_id", "text"]:
            assert out.columns == docs.columns


def test_packing_stage_of_many_shards(spark, tables, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 1)
    texts = {i: ["word " * (i % 40)] for i in range(300)}
    rows = corpus_pipeline.best_fit_packing(spark, documents([(i, t) for i, (t,) in texts.items()]), tables).collect()
    checked(rows, texts)
    shards = {r["sequence_id"] >> 25 for r in rows}
    assert min(shards) >= 0 and 128 <= max(shards) < 300
