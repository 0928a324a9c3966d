from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from docketrank.llm import packing


def checked(rows, texts, capacity=1024):
    """Pieces and places against the tokenizers library; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(packing.public_vocabulary().json_path)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc_id, own in texts.items():
        wanted = []
        for text in own:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            first = len(ids) % capacity or min(capacity, len(ids))
            for n, start in enumerate([0, *range(first, len(ids), capacity)]):
                end = first if n == 0 else start + capacity
                wanted.append((n, start, end - start, zlib.crc32(ids[start:end].tobytes())))
        assert sorted(pieces[doc_id]) == sorted(wanted)
    return len(sequences)


def test_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = packing.pack(docs, packing.public_vocabulary()).collect()
    n = checked(rows, {r["doc_id"]: [r["text"]] for r in docs.collect()})
    assert n <= -(-sum(r["length"] for r in rows) // 1024) * 1.01 + 1


def test_edge_rows(documents, edge_rows):
    extra = [(40, "a  b"), (41, " x "), (42, "a\n \nb"), (43, "<|endoftext|> x"), (44, "it's 'S  　z\t q"), (45, "a \nb")]
    rows = [*edge_rows, *extra]
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    checked(packing.pack(documents(rows), packing.public_vocabulary()).collect(), texts)
    assert packing.pack(documents([]).limit(0), packing.public_vocabulary()).count() == 0


def test_encoder_cuts_where_the_pattern_does():
    rng = random.Random(8)
    vocabulary = packing.public_vocabulary()
    encode, plain = packing.encoder(vocabulary), Tokenizer.from_file(vocabulary.json_path)
    bits = [" ", "  ", "\n", "\t", "a", "The", "é", "'s", "'ll", "12", "!", "日", " ", " ", "\x85", "don't", "x.\ny"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(12)))
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_evolution_never_loses_items_and_improves():
    rng = random.Random(3)
    lengths = [rng.choice([340, 341, 342, 500, 520, 170, 700]) for _ in range(300)]
    first = packing._packed(lengths, 1024, 0.0, rng)
    places = packing.evolve(lengths, 1, [])
    fills = defaultdict(int)
    for i, at in enumerate(places):
        fills[at] += lengths[i]
    assert max(fills.values()) <= 1024 and len(places) == 300
    assert len(fills) <= len(first.bins)
    again = packing.evolve(lengths, 2, [places])
    assert len(set(again)) <= len(fills)


def test_crossover_keeps_every_item_once():
    rng = random.Random(5)
    lengths = [rng.randrange(1, 1024) for _ in range(400)]
    a, b = (packing._packed(lengths, 1024, noise, rng) for noise in (0.0, 0.5))
    child = packing._crossed(a, b, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(400))
    assert all(sum(lengths[i] for i in items) + free == 1024 for items, free in zip(child.bins, child.free, strict=True))


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 7)
    rows = [(i, "word " * (i * 7 % 900)) for i in range(60)]
    checked(packing.pack(documents(rows), packing.public_vocabulary()).collect(), {i: [t] for i, t in rows})


def test_ids_of_far_shards():
    pieces = [{"doc_id": i or None, "piece": 0, "start": 0, "length": 300 + i, "ids_crc32": i} for i in range(3)]
    for shard in (0, 63, 64, 127, 128, 10**6):
        places = pa.array([[1, 0, 1]], pa.list_(pa.int32()))
        (out,) = packing._laid_out(iter([pa.RecordBatch.from_pydict({"shard": [shard], "pieces": [pieces], "places": places})]))
        assert out["sequence_id"].to_pylist() == [2 * (shard * 2**24 + at) for at in (1, 0, 1)]
        assert out["offset"].to_pylist() == [0, 0, 300]
        assert out["doc_id"].to_pylist() == [None, 1, 2]
