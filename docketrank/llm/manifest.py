"""A Merkle manifest of a dataset: digest trees per source and above, rolled up as nested structs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketrank.llm.common import stored

# Children of a node. A rank's digits to this base say where a leaf hangs.
FANOUT = 16
# Levels that one block rolls up: a block holds at most FANOUT ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS

# Siblings left and right of a node, as one text of digests each, level by level.
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row's values: ``-`` for NULL, else the length in UTF-8 bytes, a colon and the value."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*(field(value) for value in values))


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows``, stored, with ``rank`` (from 0) within the group and ``total`` (rows of the group).

    Rows are sorted across all tasks by range, so no group has to fit in one of them. A row's rank is
    its place in its task's sorted part and the group's rows in the parts before; only the counts per
    part and group are summed up in order, as many as there are parts and groups. NULLs come first.
    """
    keys = [*group, *order]
    spread = rows.repartitionByRange(*(F.asc_nulls_first(k) for k in keys)).sortWithinPartitions(*(F.asc_nulls_first(k) for k in keys))
    # The number has the task's part in its upper bits and the place in the part in its lower 33.
    placed = stored(spread.withColumn("q_place", F.monotonically_increasing_id()))
    part = F.shiftright("q_place", 33)
    spans = placed.groupBy(*group, part.alias("q_part")).agg(F.min("q_place").alias("q_first"), F.count("*").alias("q_rows"))
    in_group = Window.partitionBy(*group)
    before = F.sum("q_rows").over(in_group.orderBy("q_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        *(F.col(k).alias(f"s_{k}") for k in group),
        "q_part",
        (F.coalesce(before, F.lit(0)) - F.col("q_first")).alias("q_shift"),
        F.sum("q_rows").over(in_group).alias("total"),
    )
    same_span = part == spans["q_part"]
    for key in group:
        same_span = same_span & placed[key].eqNullSafe(spans[f"s_{key}"])
    return placed.join(spans, same_span).select(
        *(placed[c] for c in rows.columns), (F.col("q_place") + F.col("q_shift")).alias("rank"), "total"
    )


def _roll_up(nodes: DataFrame, group: list[str]) -> DataFrame:
    """Blocks of nodes, stored: group, ``rank`` and ``total`` of the block, its ``digest`` and ``node``.

    ``nodes`` has the group's columns, ``rank``, ``total``, ``digest`` and ``carry``, which travels along.
    Digits of the rank are grouped away from the last to the first; each time the children of a node
    become an array of structs in it. All of it happens within the one shuffle that gathers a block.
    """
    digits = [F.floor(F.col("rank") / FANOUT**k).cast("long").alias(f"d{k}") for k in range(1, BLOCK_LEVELS + 1)]
    block = f"d{BLOCK_LEVELS}"
    rows = nodes.select(
        *group, *digits, "total", (F.col("rank") % FANOUT).cast("int").alias("at"), "digest", F.col("carry").alias("kids")
    ).repartition(*group, block)
    for level in range(1, BLOCK_LEVELS + 1):
        keys = [*group, *(f"d{k}" for k in range(level, BLOCK_LEVELS + 1)), "total"]
        kids = F.sort_array(F.collect_list(F.struct("at", "digest", "kids")))
        rows = rows.groupBy(*keys).agg(kids.alias("kids"))
        # A level that has one node only is the top already: its digest goes up as it is.
        joined = F.array_join(F.transform("kids", lambda kid: kid["digest"]), "")
        several = F.col("total") > FANOUT ** (level - 1)
        rows = rows.select(
            *keys,
            (F.col(f"d{level}") % FANOUT).cast("int").alias("at"),
            F.when(several, F.sha2(joined, 256)).otherwise(F.col("kids")[0]["digest"]).alias("digest"),
            "kids",
        )
    above = F.ceil(F.col("total") / BLOCK).cast("long")
    return stored(
        rows.select(*group, F.col(block).alias("rank"), above.alias("total"), F.col("total").alias("below"), "digest", F.col("kids").alias("node"))
    )


def _unfolded(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """The nodes a block was made of: ``keep``, ``rank``, ``digest``, ``carry`` and ``steps`` up to the root.

    ``blocks`` has ``rank``, ``below``, ``node`` and the block's own ``steps``. One transform a level walks
    down the structs; a node's steps are its own siblings, then those of what holds it.
    """

    def siblings(kids: Column, i: Column) -> Column:
        def text(part: Column) -> Column:
            return F.array_join(F.transform(part, lambda kid: kid["digest"]), "")

        return F.array(F.struct(text(F.slice(kids, 1, i)).alias("left"), text(F.slice(kids, i + 2, F.lit(FANOUT))).alias("right")))

    def walk(kids: Column, level: int, rank: Column, steps: Column, total: Column) -> Column:
        here = F.lit(FANOUT ** (level - 1))

        def down(kid: Column, i: Column) -> Column:
            own = F.when(total > here, siblings(kids, i)).otherwise(F.array().cast(_STEPS))
            path, place = F.concat(own, steps), rank * FANOUT + kid["at"]
            if level > 1:
                return walk(kid["kids"], level - 1, place, path, total)
            return F.struct(place.alias("rank"), kid["digest"].alias("digest"), kid["kids"].alias("carry"), path.alias("steps"))

        found = F.transform(kids, down)
        return F.flatten(found) if level > 1 else found

    nodes = walk(F.col("node"), BLOCK_LEVELS, F.col("rank"), F.col("steps"), F.col("below"))
    return blocks.select(*keep, F.explode(nodes).alias("q_node")).select(*keep, "q_node.*")


def _tree(nodes: DataFrame, group: list[str]) -> list[DataFrame]:
    """Blocks level by level, until every group is one block.

    Only the largest group's number of nodes comes to the driver, to know how often to go on.
    """
    levels = [_roll_up(nodes, group)]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > 1:
        levels.append(_roll_up(levels[-1].withColumn("carry", F.lit(None).cast("int")), group))
    return levels


def _descend(levels: list[DataFrame], group: list[str], top: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes under the blocks of a tree, with their steps; ``top`` has ``keep`` and ``steps`` of each group.

    Steps come down from a block to its nodes inside the block's own row. Only where the nodes are blocks
    of the level below they meet these by key, a row for each 4,096 leaves.
    """
    above = top
    for i, blocks in enumerate(reversed(levels)):
        named = [F.col(k).alias(f"a_{k}") for k in group]
        if i:
            named.append(F.col("rank").alias("a_rank"))
        right = above.select(*named, *keep, "steps")
        same_block = F.lit(True)
        for k in group:
            same_block = same_block & blocks[k].eqNullSafe(right[f"a_{k}"])
        if i:
            same_block = same_block & (blocks["rank"] == right["a_rank"])
        joined = blocks.join(right, same_block).select(*(blocks[k] for k in group), blocks["rank"], "below", "node", *keep, "steps")
        above = _unfolded(joined, [*group, *keep])
    return above


def manifest(
    docs: DataFrame, columns: list[str], doc_id: str = "doc_id", source: str = "source",
    tampered: Callable[[DataFrame], dict[str, Column]] | None = None,
) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded_root`` of every row.

    ``leaf`` is the digest of ``columns`` in the order given. Per source, leaves in ascending order of
    ``doc_id`` are hashed in runs of ``FANOUT`` until one node is left, the ``subroot`` (a lone leaf is
    its own); the subroots, in ascending order of the source's UTF-8 bytes, likewise give the ``root``.
    ``proof`` holds the siblings of a row's node on each level as texts ``left`` and ``right``.
    ``folded_root`` is what these make of the row's leaf, recomputed from the values that ``tampered`` puts
    in place of some columns, if given; it equals ``root`` exactly if the row is as it was.

    A NULL source is a source of its own and comes first, so do NULL ids; rows that repeat an id are
    ordered by their leaves. Texts don't move, only digests do. An empty table gives an empty result.
    """
    spoilt = tampered(docs) if tampered else {}
    leaf = leaf_digest([F.col(c) for c in columns])
    again = leaf_digest([spoilt.get(c, F.col(c)) for c in columns])
    leaves = docs.select(
        F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), leaf.alias("digest"),
        # Only a leaf that changes is carried along.
        (F.nullif(again, leaf) if spoilt else F.lit(None).cast("string")).alias("tampered"),
    )
    nodes = ranked(leaves, ["source"], ["doc_id", "digest"])
    trees = _tree(nodes.select("source", "rank", "total", "digest", F.struct("doc_id", "tampered").alias("carry")), ["source"])
    subroots = trees[-1].select("source", "digest", F.lit(0).alias("all"))
    sources = ranked(subroots, ["all"], ["source"]).withColumn("carry", F.struct("source", F.col("digest").alias("subroot")))
    upper = _tree(sources.select("all", "rank", "total", "digest", "carry"), ["all"])
    root = upper[-1].select("all", F.col("digest").alias("root"), F.array().cast(_STEPS).alias("steps"))
    tops = _descend(upper, ["all"], root, ["root"]).select("carry.source", "carry.subroot", "root", "steps")
    found = _descend(trees, ["source"], tops, ["subroot", "root"])
    started = F.coalesce("carry.tampered", "digest")
    folded = F.aggregate("steps", started, lambda node, step: digest(step["left"], node, step["right"]))
    return found.select(
        "carry.doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.col("steps").alias("proof"), folded.alias("folded_root")
    )
