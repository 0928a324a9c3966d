from __future__ import annotations

import random

from pyspark.sql import functions as F

from docketrank.llm import chat

ROWS = "conv_id long, turn long, role string, text string, formatted int, example string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS).repartition(3)


def read(examples):
    return examples.select(
        "conv_id",
        "example",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        "loss_length",
    ).orderBy("conv_id", "example").collect()


def test_round_trip_of_nasty_texts(spark):
    rng = random.Random(6)
    bits = ["\\", "<|", "|>", "<|end|>", "<|turn|>", "<|says|>", "</s>", "<s>", "[INST]", "[/INST]", "<", "|", ">", "<<SYS>>", "é", "\n", "𝒳", " ", "$1"]
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system", "<|says|>"]), "".join(rng.choices(bits, k=rng.randrange(9))))
        for conv in range(60)
        for turn in range(rng.randrange(1, 7))
    ]
    for r in read(chat.examples(table(spark, rows))):
        own = [(role, text) for c, _, role, text in rows if c == r["conv_id"]]
        turns = [(t["role"], t["text"]) for t in r["turns"]]
        assert turns == own[: len(turns)]
        trained = turns[-1][0] == "assistant"
        assert r["loss"] == (turns[-1][1] if trained else "") and (trained or len(turns) == len(own))


def test_escaped_texts_hold_no_control_string(spark):
    df = spark.createDataFrame([("".join(chat.CONTROLS) * 2,)], "t string").select(chat.escape(F.col("t")).alias("e"))
    escaped = df.first()["e"]
    assert not any(c in escaped for c in chat.CONTROLS)


def test_every_assistant_turn_once(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (1, 4, "assistant", "b"), (1, 5, "user", "w")]
    found = read(chat.examples(table(spark, rows)))
    assert [(len(r["turns"]), r["loss"]) for r in found] == [(3, "a"), (5, "b"), (6, "")]


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "x"), (2, None, None, None), (2, 0, "assistant", None), (3, 0, "user", "tie"), (3, 0, "user", "tie"),
        (4, 0, "assistant", "long " * 50_000), (5, 0, "assistant", ""),
    ]
    by_conv = {}
    for r in read(chat.examples(table(spark, rows))):
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert set(by_conv) == {None, 2, 3, 4, 5}
    assert [(t["role"], t["text"]) for t in by_conv[2][-1]["turns"]] == [("", ""), ("assistant", "")]
    assert len(by_conv[3][-1]["turns"]) == 2 and by_conv[4][0]["loss_length"] == 250_000
    assert chat.examples(table(spark, []).limit(0)).count() == 0
