"""Chat formatting by prefix-target expansion: each assistant turn is the target of one example."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

TRAINED_ROLE = "assistant"

# Marks of the template. A turn is <|turn|>role<|says|>text<|end|>.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# Strings that some template gives a meaning; none stays as it is inside a text.
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"


def escape(text: Column) -> Column:
    """Set a backslash into every control string and before every backslash."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return reduce(lambda done, c: F.replace(done, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), CONTROLS, doubled)


def unescape(text: Column) -> Column:
    """Undo ``escape``: drop a backslash and keep what follows it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(turn: Column) -> Column:
    return F.concat(F.lit(TURN), escape(turn["role"]), F.lit(SAYS))


def _written(turn: Column) -> Column:
    return F.concat(_header(turn), escape(turn["text"]), F.lit(END))


def examples(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Training examples: ``conv_id``, ``example`` (from 0), ``formatted``, ``loss_start``, ``loss_length``.

    Each assistant turn ends one example that begins with all turns before it; only its text, as
    written, is under the loss (code points from ``loss_start``). Turns after the last assistant
    turn get a last example of the whole conversation without a target (length 0), so no turn is
    lost. Turns are ordered by ``turn``, then role and text; NULL turns come first, NULL roles and
    texts count as empty, repeated rows are turns of their own, and rows with a NULL conversation
    form one. An empty table has no examples. A conversation is one unit of work: the output holds
    every prefix of it anyway, so its turns are gathered, but never those of several at once.
    """
    turns = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn).alias("turn"),
                    F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    targets = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda n: (F.get(F.col("turns"), n - 1)["role"] == TRAINED_ROLE) | (n == F.size("turns")),
    )
    prefixes = turns.select("conv_id", "turns", F.posexplode(targets).alias("example", "n"))
    last = F.get(F.col("turns"), F.col("n") - 1)
    parts = prefixes.select(
        "conv_id",
        "example",
        F.array_join(F.transform(F.slice("turns", 1, F.col("n") - 1), _written), "").alias("context"),
        _header(last).alias("header"),
        escape(last["text"]).alias("reply"),
        (last["role"] == TRAINED_ROLE).alias("trained"),
    )
    return parts.select(
        "conv_id",
        "example",
        F.concat("context", "header", "reply", F.lit(END)).alias("formatted"),
        F.length(F.concat("context", "header")).cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.length("reply")).otherwise(0).cast("long").alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted example was written from."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, F.greatest(F.length(formatted), F.lit(1)))

    def parsed(piece: Column) -> Column:
        sides = F.split(F.substring(piece, F.lit(1), F.length(piece) - len(END)), r"<\|says\|>")
        return F.struct(unescape(F.get(sides, F.lit(0))).alias("role"), unescape(F.get(sides, F.lit(1))).alias("text"))

    return F.transform(pieces, parsed)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss of an example, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), length.cast("int")))
