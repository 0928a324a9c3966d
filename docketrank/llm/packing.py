"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import base64
import random
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from docketrank.llm.common import stored

CAPACITY = 1024
END_ID = 2
# Pieces that are packed together; more make the last, badly filled bin weigh less.
SHARD = 8192
# Per shard: islands, rounds with migration between them, generations a round, population.
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 4, 4
# A bin of at least this fill is handed on whole.
WELL_FILLED = 0.995

# The pattern that cuts texts before byte-pair merging, and the vocabulary's one
# special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Vocabulary(NamedTuple):
    """The same byte-pair vocabulary twice: for the tokenizers library, and as ranks."""

    json_path: str
    ranks_path: str


def public_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


class Encoder:
    """Ids as little-endian 32-bit numbers, equal to those of the tokenizers library.

    A text is cut before each blank that a visible character follows, where the pattern cuts as
    well, and what stands between is encoded once and kept. Texts with other white space around
    blanks are encoded whole, texts with a special token by the tokenizers library.
    """

    UNSAFE = re.compile(r" (?=\s|$)")
    KEPT = 200_000

    class _Kept(dict):
        def __init__(self, encode, before: str) -> None:
            self.encode, self.before = encode, before

        def __missing__(self, part: str) -> bytes:
            if len(self) >= Encoder.KEPT:
                self.clear()
            ids = array("I", self.encode(self.before + part)).tobytes()
            if len(part) <= 64:
                self[part] = ids
            return ids

    def __init__(self, vocabulary: Vocabulary) -> None:
        with open(vocabulary.ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        own = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode_ordinary = own.encode_ordinary
        self.whole = Tokenizer.from_file(vocabulary.json_path)
        self.parts = self._Kept(self.encode_ordinary, " ")

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.UNSAFE.search(text):
            return array("I", self.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.encode_ordinary(first)).tobytes() + b"".join(map(self.parts.__getitem__, rest))


@cache
def encoder(vocabulary: Vocabulary) -> Encoder:
    return Encoder(vocabulary)


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of ids given as bytes; only the first piece may be shorter."""
    total = len(ids) // 4
    first = total % capacity or min(total, capacity)
    bounds = [0, *range(first, total + 1, capacity)]
    return [
        (piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end]))
        for piece, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False))
    ]


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every row's text with their checksums, in document order."""
    end = array("I", [END_ID]).tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(vocabulary)
        for batch in batches:
            rows = [
                (None if pd.isna(doc_id) else int(doc_id), *piece)
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                for piece in cut(ids_of(text or "") + end, capacity)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInPandas(encode, PIECES)


class Bins:
    """A packing under construction; finds the fullest bin with room by a bit set of free space."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0

    def _list(self, at: int) -> None:
        space = self.free[at]
        if space:
            self.by_free[space].append(at)
            self.spaces |= 1 << space

    def add_bin(self, items: list[int]) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - sum(self.lengths[i] for i in items))
        self._list(len(self.bins) - 1)

    def best_fit(self, item: int) -> None:
        length = self.lengths[item]
        fits = self.spaces >> length
        if not fits:
            self.add_bin([item])
            return
        space = length + (fits & -fits).bit_length() - 1
        at = self.by_free[space].pop()
        if not self.by_free[space]:
            self.spaces ^= 1 << space
        self.bins[at].append(item)
        self.free[at] = space - length
        self._list(at)

    def quality(self) -> tuple[int, int]:
        """Fewer bins are better, then fuller ones (the sum of squared fills)."""
        return -len(self.bins), sum((self.capacity - space) ** 2 for space in self.free)


def _packed(lengths: list[int], capacity: int, noise: float, rng: random.Random) -> Bins:
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random()))
    bins = Bins(lengths, capacity)
    for item in order:
        bins.best_fit(item)
    return bins


def _crossed(giver: Bins, taker: Bins, rng: random.Random) -> Bins:
    """Well-filled bins of the giver, what they leave whole of the taker, the rest by best fit."""
    child = Bins(giver.lengths, giver.capacity)
    most_free = int((1 - WELL_FILLED) * giver.capacity)
    good = [at for at, space in enumerate(giver.free) if space <= most_free]
    injected: set[int] = set()
    for at in rng.sample(good, len(good) // 2):
        child.add_bin(list(giver.bins[at]))
        injected.update(giver.bins[at])
    displaced: list[int] = []
    for at, items in enumerate(taker.bins):
        # Badly filled bins are dissolved as well now and then, which is the mutation.
        if injected.isdisjoint(items) and (taker.free[at] <= most_free or rng.random() < 0.5):
            child.add_bin(list(items))
        else:
            displaced += [i for i in items if i not in injected]
    for item in sorted(displaced, key=lambda i: -giver.lengths[i]):
        child.best_fit(item)
    return child


def _restored(lengths: list[int], capacity: int, places: list[int]) -> Bins:
    members: dict[int, list[int]] = {}
    for item, at in enumerate(places):
        members.setdefault(at, []).append(item)
    bins = Bins(lengths, capacity)
    for items in members.values():
        bins.add_bin(items)
    return bins


def evolve(lengths: list[int], seed: int, elites: list[list[int]], capacity: int = CAPACITY) -> list[int]:
    """The bin of every item after one round on an island that begins with the given elites."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    population = [_restored(lengths, capacity, places) for places in elites]
    population.append(_packed(lengths, capacity, 0.0, rng))
    best = max(population, key=Bins.quality)
    if len(best.bins) > least:
        while len(population) < POPULATION:
            population.append(_packed(lengths, capacity, 0.3 * rng.random(), rng))
        for _ in range(GENERATIONS):
            children = [_crossed(*rng.sample(population, 2), rng) for _ in range(POPULATION)]
            population = sorted(population + children, key=Bins.quality, reverse=True)[:POPULATION]
            if len(population[0].bins) <= least:
                break
        best = population[0]
    places = [0] * len(lengths)
    for at, items in enumerate(best.bins):
        for item in items:
            places[item] = at
    return places


def _round(capacity: int, epoch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard, island, lengths, own, guest in batch.itertuples(index=False):
                sizes = [int(x) for x in lengths]
                elites = [[int(x) for x in places] for places in (own, guest) if places is not None]
                places = evolve(sizes, hash((shard, island, epoch)), elites, capacity)
                bins = _restored(sizes, capacity, places)
                rows.append((shard, island, len(bins.bins), -bins.quality()[1], places))
            yield pd.DataFrame(rows, columns=["shard", "island", "n_bins", "cost", "places"])

    return run


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece: its bin and, in order of the pieces, its place there."""
    for batch in batches:
        for shard, pieces, places in zip(batch["shard"], batch["pieces"], batch["places"], strict=True):
            # Bins come as 32-bit numbers; ids of sequences need 64 from the 64th shard on.
            at = places.values.to_numpy().astype("int64")
            columns = {name: pieces.values.field(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            lengths = pd.Series(columns["length"].to_numpy())
            columns["sequence_id"] = pa.array(2 * ((shard.as_py() << 24) + at))
            columns["offset"] = pa.array((lengths.groupby(at).cumsum() - lengths).to_numpy())
            yield pa.RecordBatch.from_pydict(columns)


def pack(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row's text with its sequence and its place there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A NULL text counts as
    empty, and an empty one is the end id alone; rows without id and repeated rows are packed like
    all others. Pieces of full length are sequences by themselves. The others are dealt evenly
    into shards of about ``SHARD`` pieces, by row and not by key; each shard evolves on several
    islands, which pass their best packings on to the next island between the rounds. An empty
    table gives no rows. ``docs`` needs columns ``doc_id`` and ``text``; others are ignored.
    """
    pieces = stored(token_pieces(docs, vocabulary, capacity).withColumn("uid", F.monotonically_increasing_id()))
    short = pieces.where(F.col("length") < capacity)
    n_shards = max(1, -(-short.count() // SHARD))
    shards = stored(
        short.groupBy(F.pmod(F.xxhash64("uid"), F.lit(n_shards)).alias("shard")).agg(
            F.sort_array(F.collect_list(F.struct("uid", "doc_id", "piece", "start", "length", "ids_crc32"))).alias("pieces")
        )
    )
    lengths = F.transform("pieces", lambda p: p["length"]).alias("lengths")
    islands = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), lengths)
    elites = None
    for epoch in range(EPOCHS):
        if elites is None:
            none = F.lit(None).cast("array<int>")
            start = islands.select("*", none.alias("own"), none.alias("guest"))
        else:
            own = elites.select("shard", "island", F.col("places").alias("own"))
            guest = elites.select(
                "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("places").alias("guest")
            )
            start = islands.join(own, ["shard", "island"]).join(guest, ["shard", "island"])
        # One task each: a few kilobytes here are seconds of work, which no merging by size may gather.
        # Beyond a multiple of the session's partitions a task evolves several, one after another.
        most = 16 * int(start.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        start = start.repartition(min(n_shards * ISLANDS, most), "shard", "island")
        elites = stored(
            start.mapInPandas(_round(capacity, epoch), "shard long, island int, n_bins int, cost long, places array<int>")
        )
    best = elites.groupBy("shard").agg(F.min(F.struct("n_bins", "cost", "island", "places")).alias("best"))
    chosen = shards.join(best, "shard").select("shard", "pieces", F.col("best.places").alias("places"))
    packed = chosen.mapInArrow(_laid_out, PIECES + ", sequence_id long, offset long")
    full = pieces.where(F.col("length") == capacity).select(
        *(F.col(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")),
        (2 * F.col("uid") + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)
