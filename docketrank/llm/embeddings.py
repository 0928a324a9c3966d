"""Embedding near-duplicates: a robust-pruned flat graph on overlapping shards, range search, verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docketrank.llm.common import stored
from docketrank.llm.graph import connected_components

SIMILAR = 0.98
# Vectors of a shard that meet in one task; larger shards are met block by block.
BLOCK = 750
# Cluster centres are fitted on a sample of about so many vectors; at most so many centres.
FIT_ROWS, MAX_CENTRES, FIT_ROUNDS = 20_000, 1024, 8
# A vector lies in the shard of its nearest centre and of every centre that is farther by this angle at
# most; about so many shards are reckoned with for that. The angle grows until the audit is content.
MARGIN, WIDER, OVERLAP = 0.08, 1.6, 2
# Graph: neighbours kept, candidates looked at, the factor of robust pruning (on angles), and among
# how many near nodes one is chosen that leads to a node which nothing else leads to.
DEGREE, CANDIDATES, ALPHA, HOOKS = 16, 48, 1.2, 4
# Search: beam to begin with, entry points; while the range expands, nodes down to this cosine lead on.
BEAM, ENTRIES, LEAD = 32, 16, 0.95
# Audit: about one query in so many is compared with everything its task holds, and so many queries with all
# vectors of their label; below this recall the beam doubles, or the shards grow.
AUDIT_EVERY, AUDIT_QUERIES, AUDIT_RECALL = 20, 2_000, 0.99

NEIGHBOURS = "label int, id long, neighbours array<long>"
COUNTS = "kind int, a long, b long"


def unit_vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Normalise to length one in double precision; leave out what has no direction."""
    for batch in batches:
        ids, labels, vectors = [], [], []
        for vec_id, label, raw in batch.itertuples(index=False):
            v = np.array([np.nan if x is None else x for x in raw], np.float64)
            if len(v) and np.isfinite(v).all() and (most := np.abs(v).max()) > 0:
                v = v / most
                ids.append(vec_id)
                labels.append(label)
                vectors.append(v / np.sqrt(v @ v))
        yield pd.DataFrame({"id": ids, "label": labels, "unit": vectors})


def fit_centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, begun at rows spread evenly over the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(FIT_ROUNDS):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def robust_prune(sims: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Neighbours of every node, -1 for none, out of its ``near`` ones in ascending order of distance.

    Each time the nearest one left is kept, and those go that it is much nearer to than the node is. All
    nodes of a block take a step at once.
    """
    rows = np.arange(len(near))[:, None]
    angle = np.arccos(np.clip(sims, -1, 1))
    far, left = angle[rows, near], near != rows
    kept = np.full((len(near), DEGREE), -1)
    for step in range(DEGREE):
        first = left.argmax(axis=1)
        some = left[rows[:, 0], first]
        best = np.where(some, near[rows[:, 0], first], 0)
        kept[some, step] = best[some]
        left &= ALPHA * angle[best[:, None], near] > far
        left[rows[:, 0], first] = False
    return kept


def build_graph(units: np.ndarray) -> list[list[int]]:
    """Out-neighbours of every vector, with edges turned round where the other end has room."""
    sims = units @ units.T
    n = len(units)
    width = min(n, CANDIDATES)
    near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1, kind="stable"), axis=1)
    graph = [[x for x in kept if x >= 0] for kept in robust_prune(sims, near).tolist()]
    for node, neighbours in enumerate([list(x) for x in graph]):
        for other in neighbours:
            if node not in graph[other] and len(graph[other]) < 2 * DEGREE:
                graph[other].append(node)
    # What no walk from the medoids reaches hangs on one of the nearest nodes that a walk does.
    lost = np.flatnonzero(~_reached(graph, medoids(units)))
    there = np.setdiff1d(np.arange(n), lost)
    for node in lost.tolist():
        close = there[np.argpartition(-sims[node, there], min(HOOKS, len(there)) - 1)[:HOOKS]]
        graph[min(close.tolist(), key=lambda x: len(graph[x]))].append(node)
    return graph


def _reached(graph: list[list[int]], entry: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(graph), bool)
    seen[entry] = True
    waiting = entry.tolist()
    while waiting:
        for node in graph[waiting.pop()]:
            if not seen[node]:
                seen[node] = True
                waiting.append(node)
    return seen


def medoids(units: np.ndarray, how_many: int = ENTRIES) -> np.ndarray:
    """Entry points: the vector nearest the mean, then each time the one farthest from those."""
    found = [int((units @ units.mean(axis=0)).argmax())]
    nearest = units @ units[found[0]]
    while len(found) < min(how_many, len(units)):
        found.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[found[-1]])
    return np.array(found)


def range_search(
    units: np.ndarray, table: np.ndarray, queries: np.ndarray, beam: int, own: np.ndarray | None = None,
    threshold: float = SIMILAR,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) with cosine >= threshold that a search of the graph meets.

    ``table`` has the neighbours of every vector, -1 for none. From the medoids, and from the
    vector that it is itself (``own``) if the graph holds it, each query walks greedily with a
    beam; then the range expands: every vector met that is near enough leads on to
    its neighbours, until nothing new is near.
    """
    n, n_queries = len(units), len(queries)
    seen = np.zeros((n_queries, n), bool)
    entry = medoids(units)
    beam_ids = np.tile(entry, (n_queries, 1))
    beam_sims = queries @ units[entry].T
    seen[:, entry] = True
    if own is not None:
        sims = np.where(seen[np.arange(n_queries), own], -3.0, np.einsum("qd,qd->q", queries, units[own]))
        seen[np.arange(n_queries), own] = True
        beam_ids, beam_sims = np.column_stack([beam_ids, own]), np.column_stack([beam_sims, sims])
    open_ = beam_sims > -3.0
    beam = max(beam, beam_ids.shape[1])
    hits_q, hits_v, lead_q, lead_v = [], [], [], []

    def note(q: np.ndarray, v: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hits_q.append(q[s >= threshold])
        hits_v.append(v[s >= threshold])
        return q[s >= LEAD], v[s >= LEAD]

    q0 = np.repeat(np.arange(n_queries), beam_ids.shape[1])
    first = note(q0, beam_ids.ravel(), beam_sims.ravel())
    lead_q.append(first[0])
    lead_v.append(first[1])
    while True:
        ranked = np.where(open_, beam_sims, -2.0)
        best = ranked.argmax(axis=1)
        live = np.flatnonzero(ranked[np.arange(n_queries), best] > -2.0)
        if not len(live):
            break
        node = beam_ids[live, best[live]]
        open_[live, best[live]] = False
        nxt = table[node]
        ok = nxt >= 0
        ok &= ~seen[live[:, None], np.where(ok, nxt, 0)]
        seen[np.repeat(live, ok.sum(axis=1)), nxt[ok]] = True
        sims = np.where(ok, np.einsum("qd,qkd->qk", queries[live], units[np.where(ok, nxt, 0)]), -3.0)
        more = note(np.repeat(live, ok.sum(axis=1)), nxt[ok], sims[ok])
        lead_q.append(more[0])
        lead_v.append(more[1])
        if beam_ids.shape[1] < beam + table.shape[1]:
            pad = beam + table.shape[1] - beam_ids.shape[1]
            beam_ids = np.pad(beam_ids, ((0, 0), (0, pad)))
            beam_sims = np.pad(beam_sims, ((0, 0), (0, pad)), constant_values=-3.0)
            open_ = np.pad(open_, ((0, 0), (0, pad)))
        beam_ids[live, beam:] = np.where(ok, nxt, 0)
        beam_sims[live, beam:] = sims
        open_[live, beam:] = ok
        order = np.argsort(-beam_sims[live], axis=1, kind="stable")
        beam_ids[live] = np.take_along_axis(beam_ids[live], order, axis=1)
        beam_sims[live] = np.take_along_axis(beam_sims[live], order, axis=1)
        open_[live] = np.take_along_axis(open_[live], order, axis=1)
        open_[:, beam:] = False
        beam_sims[:, beam:] = -3.0
    # The beam has met most of what is near; now everything near leads on, a block at a time.
    pending_q, pending_v = np.concatenate(lead_q), np.concatenate(lead_v)
    while len(pending_q):
        step_q, step_v = pending_q[:100_000], pending_v[:100_000]
        pending_q, pending_v = pending_q[100_000:], pending_v[100_000:]
        nxt = table[step_v].ravel()
        owner = np.repeat(step_q, table.shape[1])
        ok = nxt >= 0
        nxt, owner = nxt[ok], owner[ok]
        new = ~seen[owner, nxt]
        pair = np.unique(owner[new] * n + nxt[new])
        owner, nxt = pair // n, pair % n
        seen[owner, nxt] = True
        sims = np.concatenate(
            [np.einsum("pd,pd->p", queries[owner[i : i + 50_000]], units[nxt[i : i + 50_000]]) for i in range(0, len(owner), 50_000)]
            or [np.zeros(0)]
        )
        more_q, more_v = note(owner, nxt, sims)
        pending_q, pending_v = np.concatenate([pending_q, more_q]), np.concatenate([pending_v, more_v])
    return np.concatenate(hits_q), np.concatenate(hits_v)


def audited_search(
    units: np.ndarray, table: np.ndarray, queries: np.ndarray, audited: np.ndarray, own: np.ndarray | None = None
):
    """Range search whose beam doubles until the audited queries miss next to nothing.

    Returns the pairs, how many links the audited queries have, and how many were found.
    """
    beam = min(BEAM, len(units))
    truth = queries[audited] @ units.T >= SIMILAR
    while True:
        q, v = range_search(units, table, queries, beam, own)
        found = np.zeros((len(queries), len(units)), bool)
        found[q, v] = True
        met = int((found[audited] & truth).sum())
        if met >= AUDIT_RECALL * truth.sum() or beam >= len(units):
            return q, v, int(truth.sum()), met
        beam = min(2 * beam, len(units))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def _shard_table(column: pd.Series, none: int) -> np.ndarray:
    table = np.full((len(column), max(map(len, column))), none, np.int64)
    for i, shards in enumerate(column):
        table[i, : len(shards)] = shards
    return table


def shards_of(units: np.ndarray, centres: np.ndarray, margin: float) -> list[list[int]]:
    """The shards of every vector: its nearest centre and those farther by ``margin`` at most.

    A vector at an angle t from another is at most 2 t farther from the other's nearest centre than from
    its own, so with a margin of that size every pair shares a shard; in practice far less will do.
    """
    angle = np.arccos(np.clip(units @ centres.T, -1, 1))
    return [np.flatnonzero(row).astype(np.int32).tolist() for row in angle <= angle.min(axis=1, keepdims=True) + margin]


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """Adjacency lists of one block of a shard."""
    rows = rows.sort_values("id")
    ids = rows["id"].to_numpy()
    graph = build_graph(_matrix(rows["unit"]))
    return pd.DataFrame(
        {"label": rows["label"].to_numpy(), "id": ids, "neighbours": [ids[x].tolist() for x in graph]}
    )


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a shard (or within one).

    Rows (0, id, copies linked) add to a vector's count of links; rows (1, id, id) connect what is
    linked, one fewer than a component has members; one row (2, links, found) is the audit's.
    A pair that several shards hold counts in the first of them only.
    """
    rows = rows.sort_values(["block", "id"]).reset_index(drop=True)
    shard, low, high = int(rows["shard"][0]), int(rows["low"][0]), int(rows["high"][0])
    index = rows[rows["block"] == low].reset_index(drop=True)
    asked = index if low == high else rows[rows["block"] == high].reset_index(drop=True)
    empty = pd.DataFrame({"kind": [], "a": [], "b": []}).astype({"kind": "int32", "a": "int64", "b": "int64"})
    if not len(index) or not len(asked):
        return empty
    ids, asked_ids = index["id"].to_numpy(), asked["id"].to_numpy()
    lists = [np.asarray(x, np.int64) for x in index["neighbours"]]
    at = [np.searchsorted(ids, x) for x in lists]
    here = [p[(p < len(ids)) & (ids[np.minimum(p, len(ids) - 1)] == x)] for p, x in zip(at, lists, strict=True)]
    table = np.full((len(ids), max(1, max(map(len, here)))), -1)
    for i, p in enumerate(here):
        table[i, : len(p)] = p
    units, queries = _matrix(index["unit"]), _matrix(asked["unit"])
    audited = np.flatnonzero(asked_ids % AUDIT_EVERY == 0)
    # Within a block every query is a node of the graph; across blocks it has to be led there.
    own = np.arange(len(ids)) if low == high else None
    q, v, links, met = audited_search(units, table, queries, audited, own)
    if low == high:
        # A search may meet a pair from one side only.
        a, b = np.minimum(q, v), np.maximum(q, v)
        pair = np.unique((a * len(ids) + b)[a != b])
        q, v = pair // len(ids), pair % len(ids)
    first, second = _shard_table(asked["shards"], -1)[q], _shard_table(index["shards"], -2)[v]
    common = (first[:, :, None] == second[:, None, :]).any(axis=2)
    owner = np.where(common, first, np.iinfo(first.dtype).max).min(axis=1)
    q, v = q[owner == shard], v[owner == shard]
    # Verify in double precision.
    exact = np.concatenate(
        [np.einsum("pd,pd->p", queries[q[i : i + 50_000]], units[v[i : i + 50_000]]) for i in range(0, len(q), 50_000)]
        or [np.zeros(0)]
    )
    q, v = q[exact >= SIMILAR], v[exact >= SIMILAR]
    counts: dict[int, int] = {}
    for linked, others in (
        (asked_ids[q], index["copies"].to_numpy()[v]),
        (ids[v], asked["copies"].to_numpy()[q]),
    ):
        unique, place = np.unique(linked, return_inverse=True)
        for node, total in zip(unique.tolist(), np.bincount(place, weights=others, minlength=len(unique)), strict=True):
            counts[node] = counts.get(node, 0) + int(total)
    nodes, place = np.unique(np.concatenate([asked_ids[q], ids[v]]), return_inverse=True)
    left, right, label = place[: len(q)], place[len(q) :], np.arange(len(nodes))
    while len(left):
        x, y = label[left], label[right]
        apart = x != y
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, label[label]):
            label = label[label]
    member = np.flatnonzero(label != np.arange(len(nodes)))
    edges = [(1, x, y) for x, y in zip(nodes[member].tolist(), nodes[label[member]].tolist(), strict=True)]
    out = [(0, node, total) for node, total in counts.items()] + edges + [(2, links, met)]
    return pd.DataFrame(out, columns=["kind", "a", "b"]).astype({"kind": "int32", "a": "int64", "b": "int64"})


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row; and the audit's counts.

    Rows link if their labels are equal and not NULL and their cosine is 0.98 or more. A vector
    that is NULL, empty, zero or holds NULL or non-finite components, or whose label or id is NULL,
    links with nothing and is its own component. Equal vectors of a label are merged first and
    count with their number of copies, so a group of copies costs one vector; repeated ids count
    as the rows they are. An empty table gives an empty result. Labels must fit in 32 bits.

    Shards are the cells of a few k-means centres (fitted on a bounded sample) within a label; each
    vector lies in its nearest and in others nearly as near. A shard of over ``BLOCK`` vectors is dealt
    into blocks, and each pair of blocks meets in a task of its own: searches of a block's graph.
    Adjacency lists built in several shards are united before the search. At last ``AUDIT_QUERIES``
    vectors are compared with all vectors of their label; while links are missing among theirs beyond
    ``AUDIT_RECALL``, shards are made to overlap more and all is done again.
    """
    named = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), F.col(embedding).alias("v")
    )
    merged = (
        named.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )
    reps = stored(merged)
    units = stored(
        reps.select("id", "label", "v").mapInPandas(unit_vectors, "id long, label int, unit array<double>")
    )
    n, n_labels = units.agg(F.count("*"), F.count_distinct("label")).first()
    k = int(min(MAX_CENTRES, max(1, -(-OVERLAP * n // (max(1, n_labels) * BLOCK)))))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    taken = units.where(drawn < int(min(1.0, FIT_ROWS / max(1, n)) * 1_000_000)).orderBy("id").select("unit")
    sample = _matrix(taken.toPandas()["unit"])
    centres = fit_centres(sample, min(k, len(sample))) if len(sample) else np.zeros((1, 1))
    weighted = units.join(reps.select("id", "label", "copies"), ["id", "label"])
    queries = weighted.where(drawn >= 1_000_000 - int(min(1.0, AUDIT_QUERIES / max(1, n)) * 1_000_000))
    truth = stored(_all_links(weighted, queries))
    margin = MARGIN
    while True:
        found = stored(_found(weighted, centres, margin))
        links = found.where("kind = 0").groupBy(F.col("a").alias("l_id")).agg(F.sum("b").alias("links"))
        audit = truth.join(links, F.col("q_id") == F.col("l_id"), "left").agg(
            F.coalesce(F.sum("true_links"), F.lit(0)).alias("links"), F.coalesce(F.sum("links"), F.lit(0)).alias("found")
        )
        wanted, met = audit.first()
        if met >= AUDIT_RECALL * wanted or margin > np.pi:
            break
        margin *= WIDER
    edges = found.where("kind = 1").select("a", "b")
    components = connected_components(edges)
    classes = (
        reps.join(units.select(F.col("id").alias("u_id")), F.col("id") == F.col("u_id"))
        .join(links, F.col("id") == F.col("l_id"), "left")
        .join(components, F.col("id") == F.col("node"), "left")
        .select(
            F.col("label").alias("c_label"),
            F.col("v").alias("c_v"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .where("n_links > 0")
    )
    result = named.join(classes, (F.col("label") == F.col("c_label")) & (F.col("v") == F.col("c_v")), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"),
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return result.withColumn("kept", kept), audit


def _all_links(units: DataFrame, queries: DataFrame) -> DataFrame:
    """``q_id`` and ``true_links`` of a bounded set of queries: their links among all vectors of their label."""
    asked = queries.select("id", "label", "unit").limit(2 * AUDIT_QUERIES).toPandas()
    by_label = {
        label: (rows["id"].to_numpy(), _matrix(rows["unit"])) for label, rows in asked.groupby("label")
    }

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, totals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for label, rows in batch.groupby("label"):
                if label in by_label:
                    q_ids, asked_units = by_label[label]
                    near = _matrix(rows["unit"]) @ asked_units.T >= SIMILAR
                    near &= rows["id"].to_numpy()[:, None] != q_ids[None, :]
                    ids.append(q_ids)
                    totals.append(rows["copies"].to_numpy() @ near)
            yield pd.DataFrame({"q_id": np.concatenate(ids), "n": np.concatenate(totals)})

    return units.mapInPandas(count, "q_id long, n long").groupBy("q_id").agg(F.sum("n").alias("true_links"))


def _found(units: DataFrame, centres: np.ndarray, margin: float) -> DataFrame:
    """What the searches of all blocks find (``_search``)."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(shards=shards_of(_matrix(batch["unit"]), centres, margin) if len(batch) else [])

    assigned = stored(units.mapInPandas(assign, "id long, label int, unit array<double>, copies long, shards array<int>"))
    placed = assigned.select("*", F.explode("shards").alias("shard"))
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    sizes = stored(placed.groupBy("label", "shard").count().select("label", "shard", blocks.alias("blocks")))
    dealt = placed.join(sizes, ["label", "shard"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    graph = dealt.groupBy("label", "shard", "block").applyInPandas(
        lambda rows: _build(rows[["label", "id", "unit"]]), NEIGHBOURS
    )
    united = graph.groupBy("label", "id").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")
    )
    tasks = (
        dealt.join(united, ["label", "id"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("other", "blocks")
    )
    return tasks.groupBy("label", "shard", "low", "high").applyInPandas(_search, COUNTS)
