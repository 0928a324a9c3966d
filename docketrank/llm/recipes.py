"""Exact duplicates by recipes: texts cut into chunks where their content says so, compared as lists of chunk ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketrank.llm.common import ASCII_SPACE, let, stored

# A token is a word with the blank behind it; longer words are cut, so that no token is unbounded.
TOKEN_CHARS = 48
# One pair of neighbouring tokens in so many ends a chunk; a longer stretch is cut after so many tokens.
CHUNK_TOKENS, MOST_TOKENS = 64, 512

ChunkHash = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """The text by which copies are told: each run of ASCII white space is one blank; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{ASCII_SPACE}+", " ")


def chunks_of(plain: Column) -> Column:
    """A normalised text as chunks, whose concatenation is the text; an empty text has none.

    Whether a chunk ends after a token depends on this token and the one before only, so an insertion
    changes the chunks around it and the rest of the text keeps its chunks.
    """
    tokens = F.regexp_extract_all(plain, F.lit(f"[^ ]{{0,{TOKEN_CHARS}}} |[^ ]{{1,{TOKEN_CHARS}}}"), F.lit(0))

    def starts(parts: Column) -> Column:
        after = F.transform(
            parts, lambda part, i: F.when(F.xxhash64(F.get(parts, i - 1), part) % CHUNK_TOKENS == 0, i + 1)
        )
        return F.concat(F.array(F.lit(0)), F.filter(after, lambda i: i < F.size(parts)))

    def split(parts: Column, begins: Column) -> Column:
        even = F.flatten(
            F.transform(
                begins,
                lambda at, k: F.sequence(at, F.coalesce(F.get(begins, k + 1), F.size(parts)) - 1, F.lit(MOST_TOKENS)),
            )
        )
        return let(
            even,
            lambda cuts: F.transform(
                cuts,
                lambda at, k: F.array_join(
                    F.slice(parts, at + 1, F.coalesce(F.get(cuts, k + 1), F.size(parts)) - at), ""
                ),
            ),
        )

    whole = let(tokens, lambda parts: let(starts(parts), lambda begins: split(parts, begins)))
    return F.when(F.length(plain) == 0, F.array().cast("array<string>")).otherwise(whole)


def _chunk_numbers(rows: DataFrame, clashes: DataFrame, chunk_hash: ChunkHash) -> DataFrame:
    """Row by row, the places whose chunk shares its hash with another text, and the chunk's number among these.

    ``rows`` has ``row`` and ``chunks``; ``clashes`` the hashes that stand for several texts.
    """
    at = rows.select("row", F.posexplode("chunks").alias("place", "chunk")).withColumn("hash", chunk_hash(F.col("chunk")))
    wanted = at.join(clashes, "hash")
    by_text = Window.partitionBy("hash").orderBy("chunk")
    number = wanted.select("hash", "chunk").distinct().withColumn("number", F.row_number().over(by_text).cast("long"))
    return (
        wanted.join(number, ["hash", "chunk"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
        .withColumnRenamed("row", "n_row")
    )


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_hash: ChunkHash = F.xxhash64) -> DataFrame:
    """Stored, per row: ``row`` (any number, its own), ``doc_id``, ``sha256`` of the normalised text and
    ``recipe``, an array of chunk ids: two texts are equal exactly if their recipes are.

    A chunk's id is its 64-bit hash, verified: all chunks are brought together once, as distinct texts,
    and hashes that stand for more than one text are looked for. Where there are any, the text's number
    among them is put behind the recipe of every row it occurs in.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("plain"),
    )
    sha256 = F.sha2("plain", 256).alias("sha256")
    cut = rows.select("row", "doc_id", sha256, chunks_of(F.col("plain")).alias("chunks"))
    recipe = F.transform("chunks", lambda chunk: chunk_hash(chunk)).alias("recipe")
    texts = docs.select(F.explode(chunks_of(normalised(F.col(text)))).alias("chunk"))
    verified = texts.select(chunk_hash(F.col("chunk")).alias("hash"), "chunk").distinct()
    clashes = stored(verified.groupBy("hash").count().where("count > 1").select("hash"))
    if clashes.isEmpty():
        return stored(cut.select("row", "doc_id", "sha256", recipe))
    # Numbers of rows hold within one computation only, so here the chunks are stored beside them.
    held = stored(cut)
    numbers = _chunk_numbers(held, clashes, chunk_hash)
    behind = F.flatten(F.transform("numbers", lambda n: F.array(n["place"].cast("long"), n["number"])))
    numbered = F.concat("recipe", F.coalesce(behind, F.array().cast("array<bigint>"))).alias("recipe")
    table = held.select("row", "doc_id", "sha256", recipe)
    return stored(table.join(numbers, table["row"] == numbers["n_row"], "left").select("row", "doc_id", "sha256", numbered))


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_hash: ChunkHash = F.xxhash64
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row.

    Texts are equal if they are after each run of ASCII white space became one blank; NULL counts as an
    empty text, and empty texts equal each other. ``keep_id`` is the smallest id among the rows of equal
    texts, NULL if none has an id, and exactly one row of them is ``kept``: one with that id, any one of
    those that repeat it, or any one where no row has an id. Other columns are ignored; an empty table
    gives an empty result.

    Texts move once at most, as distinct chunks, already merged in the task that reads them. What is
    compared and grouped are recipes, about a fiftieth of the texts: first minima and counts per recipe,
    also merged before they move, then only recipes that occur twice join the rows.
    """
    table = recipes(docs, doc_id, text, chunk_hash)
    groups = stored(
        table.groupBy(F.col("recipe").alias("g_recipe"))
        .agg(
            F.count("*").alias("g_size"),
            F.min("doc_id").alias("g_id"),
            F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("g_row"),
        )
        .where("g_size > 1")
    )
    joined = table.join(groups, table["recipe"] == groups["g_recipe"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("g_size").isNull(), F.col("doc_id")).otherwise(F.col("g_id")).alias("keep_id"),
        F.coalesce("g_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("g_row"), F.lit(True)).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )
