"""SimHash near-duplicates, found with a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from docketrank.llm.common import stored
from docketrank.llm.graph import connected_components

SHINGLE = 4
MAX_DISTANCE = 4

# A fingerprint is cut into six segments. Two that differ in at most four bits agree in at least
# two of them, so every link lies in a bucket of one of the fifteen pairs of segments.
SEGMENTS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
# Fingerprints of a bucket that meet in one task; larger buckets are met block by block.
BLOCK = 1024
# Children of a node of the index.
FANOUT = 8
# Bounds of what one step of a search may hold: fingerprints indexed at once, possible hits.
INDEX_AT_ONCE = 100_000
HITS_AT_ONCE = 2_000_000


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """One hash per run of ``shingle`` words, of all words if there are fewer; none if there is no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - shingle + 1]
    stops = ends[shingle - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text; zero if it has no word."""
    hashes = shingle_hashes(text, shingle)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


def fingerprint_of(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long").asNondeterministic()(text)


def hex_text(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the sequence of Gray code words."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A forest of masked bit patterns, one tree a bucket, over fingerprints in Gray order.

    A node keeps the bits that all fingerprints below it share, less those that a node above it
    keeps already. A search adds up differences on the way down and drops a whole subtree once
    they exceed the limit; at a fingerprint the sum is the exact distance.
    """

    def __init__(self, values: np.ndarray, buckets: np.ndarray) -> None:
        self.order = np.lexsort((gray_rank(values), buckets))
        self.values = values[self.order]
        self.buckets = buckets[self.order]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        size = len(values)
        masks, shown, owner = np.full(size, full), self.values, self.buckets
        last = np.arange(size)
        self.levels: list[dict[str, np.ndarray]] = [{"mask": masks, "value": shown, "last": last}]
        while True:
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
            start = np.flatnonzero(place % FANOUT == 0)
            count = np.diff(np.r_[start, len(owner)])
            if len(self.levels) > 1 and len(start) == len(owner):
                break
            shared = np.bitwise_and.reduceat(masks, start)
            shared &= ~(np.bitwise_or.reduceat(shown & masks, start) ^ np.bitwise_and.reduceat(shown | ~masks, start))
            below = self.levels[-1]
            below["mask"] = masks & ~np.repeat(shared, count)
            masks, shown, owner, last = shared, shown[start] & shared, owner[start], last[start + count - 1]
            self.levels.append({"mask": masks, "value": shown, "last": last, "start": start, "count": count})
        self.root = np.repeat(np.arange(len(owner)), np.diff(np.r_[np.searchsorted(self.buckets, owner), size]))

    def links(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (query, later fingerprint of its bucket) within the limit."""
        node, query = self.root[queries], queries
        added = np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            difference = (self.values[query] ^ level["value"][node]) & level["mask"][node]
            added = added + np.bitwise_count(difference)
            keep = (added <= limit) & (level["last"][node] > query)
            node, query, added = node[keep], query[keep], added[keep]
            if depth:
                count = level["count"][node]
                query, added = np.repeat(query, count), np.repeat(added, count)
                first = np.repeat(level["start"][node], count)
                node = first + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
        return query, node


def bucket_forest(values: np.ndarray, buckets: np.ndarray, limit: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked within a bucket: indices of members and of their heads.

    All links are found, but a component of n members yields n - 1 of them.
    """
    index = GrayIndex(values, buckets)
    sizes = np.bincount(np.unique(index.buckets, return_inverse=True)[1])
    hits = np.cumsum(np.repeat(sizes, sizes))
    label = np.arange(len(values))
    at = 0
    while at < len(values):
        upto = int(np.searchsorted(hits, (hits[at - 1] if at else 0) + HITS_AT_ONCE, side="right"))
        upto = max(upto, at + 1)
        left, right = index.links(np.arange(at, upto), limit)
        while len(left):
            a, b = label[left], label[right]
            apart = a != b
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(label, label[label]):
                label = label[label]
        at = upto
    member = np.flatnonzero(label != np.arange(len(values)))
    return index.order[member], index.order[label[member]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        offsets = np.asarray(lists.offsets)
        at = 0
        while at < len(lists):
            upto = max(int(np.searchsorted(offsets, offsets[at] + INDEX_AT_ONCE, side="right")) - 1, at + 1)
            span = slice(offsets[at], offsets[upto])
            values = np.asarray(lists.values)[span].view(np.uint64)
            ids = np.asarray(batch.column(1).values)[span]
            buckets = np.repeat(np.arange(at, upto), np.diff(offsets[at : upto + 1]))
            member, head = bucket_forest(values, buckets)
            yield pa.RecordBatch.from_pydict({"a": ids[member], "b": ids[head]})
            at = upto


def _bucket_keys(value: Column) -> Column:
    parts = [F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1)) for start, width in SEGMENTS]
    pairs = combinations(range(len(SEGMENTS)), 2)
    return F.array(
        *(F.shiftleft(F.shiftleft(parts[a], 11).bitwiseOR(parts[b]), 4).bitwiseOR(F.lit(i)) for i, (a, b) in enumerate(pairs))
    )


def fingerprint_links(groups: DataFrame) -> DataFrame:
    """Links (a, b) between ids whose fingerprints differ in at most four bits.

    ``groups`` has distinct fingerprints ``fp`` and an id ``rep`` each. The links connect exactly
    what all links would. A bucket of over ``BLOCK`` fingerprints is dealt into blocks by hash and
    each pair of blocks meets in a task of its own, so no task holds a bucket of any size.
    """
    keyed = groups.select("fp", "rep", F.explode(_bucket_keys(F.col("fp"))).alias("bucket"))
    large = stored(keyed.groupBy("bucket").count().where(F.col("count") > BLOCK))
    blocks = F.coalesce(F.ceil(F.col("count") / BLOCK).cast("int"), F.lit(1))
    dealt = keyed.join(large, "bucket", "left").select(
        "fp", "rep", "bucket", blocks.alias("blocks"), F.pmod(F.xxhash64("fp").cast("bigint"), blocks).alias("block")
    )
    met = dealt.select(
        "fp", "rep", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    tasks = (
        met.groupBy("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .agg(F.collect_list(F.struct("fp", "rep")).alias("members"))
        .where(F.size("members") > 1)
        .select(F.col("members.fp").alias("fps"), F.col("members.rep").alias("reps"))
    )
    return tasks.mapInArrow(_search, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``component_id`` of every row.

    Texts link if their fingerprints differ in at most four bits; ``component_id`` is the smallest
    id reachable by links, the row's own included. NULL and empty texts have fingerprint zero and
    link like any other. A row without id belongs to the component of its fingerprint's smallest
    id, if there is one, else to none, and links nothing. Repeated rows share a component. Equal
    fingerprints are merged before anything else, so a group of copies counts once.
    """
    prints = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint_of(F.col(text)).alias("fp")))
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("rep IS NOT NULL")
    groups = stored(groups)
    components = connected_components(fingerprint_links(groups.select("fp", "rep")))
    joined = groups.join(components, groups["rep"] == components["node"], "left")
    shared = joined.where("n > 1 OR component IS NOT NULL").select(
        F.col("fp").alias("g_fp"), F.coalesce("component", "rep").alias("component")
    )
    return prints.join(shared, prints["fp"] == shared["g_fp"], "left").select(
        "doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id; columns unchanged.

    Of rows that repeat an id one stays; rows without id stay, as nothing tells them apart.
    The ids to drop are stored first: what joins the texts is a small table of known size.
    """
    found = stored(near_duplicates(docs))
    drop = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("drop_id")).distinct())
    again = stored(
        found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("again_id")).count().where("count > 1").drop("count")
    )
    rest = docs.join(drop, docs["doc_id"] == drop["drop_id"], "left_anti")
    single = rest.join(again, rest["doc_id"] == again["again_id"], "left_anti")
    repeated = rest.join(again, rest["doc_id"] == again["again_id"], "left_semi")
    by_id = Window.partitionBy("doc_id").orderBy(*(F.col(name) for name in ("text", "lang", "source", "n_chars")))
    first = repeated.withColumn("q_place", F.row_number().over(by_id)).where("q_place = 1").drop("q_place")
    return single.unionByName(first)
