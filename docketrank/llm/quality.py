"""Quality rules with thresholds that the corpus sets itself, per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docketrank.llm.common import ASCII_SPACE, let, same, split_words, stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# A feature's sketch: a histogram of its values as whole numbers, clamped to 0..top, so at most
# top + 1 counts a group; sketches merge by adding counts and a quantile is off by under 1.
# A fence lies ``REACH`` spreads outside the quartiles; a spread is the distance of the quartiles,
# at least ``floor``, so that groups of nearly equal texts don't reject the slightest difference.
REACH = 3
FEATURES = {
    # name: (what it measures, top, floor, has a lower fence)
    "symbols": ("100 * n_symbols / n_words", 1000, 5, False),
    "word_length": ("10 * word_chars / n_words", 1000, 10, True),
    "dup_lines": ("100 * n_dup_lines / n_lines", 100, 15, False),
    "stutter": ("100 * n_stutter / n_words", 100, 8, False),
}


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice, from the windows' hashes in order."""

    def covered(places: Column) -> Column:
        steps = F.zip_with(
            places,
            F.slice(places, 2, F.greatest(F.size(places), F.lit(1))),
            lambda here, following: F.least(F.lit(WINDOW), F.coalesce(following - here, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def places(ordered: Column) -> Column:
        def twice(item: Column, at: Column) -> Column:
            before = F.when(at > 0, F.get(ordered, at - 1)["h"] == item["h"])
            after = F.get(ordered, at + 1)["h"] == item["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twice), lambda item: item["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = let(ordered, lambda o: let(places(o), covered))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0))


def text_measures(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep`` and the base measures of a text, in columns of one struct each for words and lines.

    Windows are compared by 64-bit hashes of word hashes; all else is exact.
    """
    words = docs.select(*keep, F.col(text).alias("q_text"), split_words(F.col(text), ASCII_SPACE).alias("q_words"))
    lines = F.filter(F.split(F.coalesce("q_text", F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    kept = [F.col(name) for name in words.columns if name not in ("q_text", "q_words")]
    hashed = words.select(
        *kept,
        F.size("q_words").alias("q_n"),
        F.length(F.array_join("q_words", "")).alias("q_chars"),
        F.coalesce(F.regexp_count(F.col("q_text"), F.lit(r"[#*$%&|<>]")), F.lit(0)).alias("q_symbols"),
        lines.alias("q_lines"),
        F.transform("q_words", lambda word: F.xxhash64(word)).alias("q_hashes"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("q_n") - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(F.col("q_hashes"), i + k) for k in range(WINDOW))),
    )
    stutter = F.zip_with(
        "q_hashes", F.slice("q_hashes", 2, F.greatest("q_n", F.lit(1))), lambda a, b: F.when(a == b, F.lit(True))
    )
    counted = hashed.select(
        *kept,
        "q_n",
        "q_chars",
        "q_symbols",
        F.size("q_lines").alias("q_n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).alias("q_dup_lines"),
        F.size(F.array_compact(stutter)).alias("q_stutter"),
        F.when(F.col("q_n") > WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("q_windows"),
    )
    return counted.select(
        *kept,
        F.col("q_n").cast("long").alias("n_words"),
        F.col("q_chars").cast("long").alias("word_chars"),
        F.col("q_symbols").cast("long").alias("n_symbols"),
        F.col("q_dup_lines").cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("q_windows")).cast("long").alias("n_repeat_words"),
        F.col("q_n_lines").cast("long").alias("n_lines"),
        F.col("q_stutter").cast("long").alias("n_stutter"),
    )


def _feature(name: str) -> Column:
    ratio, top, _, _ = FEATURES[name]
    above, below = ratio.split(" / ")
    value = F.expr(f"CASE WHEN {below} > 0 THEN ({above}) div {below} ELSE 0 END")
    return F.least(value, F.lit(top)).cast("int")


def fences(measured: DataFrame) -> DataFrame:
    """Lower and upper limit of every feature per language and source (NULL is a group as well).

    The sketches are plain counts, combined before the shuffle, so a source with a third of all
    rows sends as few rows as any other.
    """
    values = F.explode(
        F.array(*(F.struct(F.lit(name).alias("feature"), _feature(name).alias("v")) for name in FEATURES))
    )
    sketch = (
        measured.select("q_lang", "q_source", values.alias("x"))
        .groupBy("q_lang", "q_source", "x.feature", "x.v")
        .agg(F.count("*").alias("n"))
    )
    group = ["q_lang", "q_source"]
    counts = sketch.groupBy(*group, "feature").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("v", "n"))).alias("bins")
    )

    def quantile(percent: int) -> Column:
        """The least value that at least this share of the rows doesn't exceed."""
        seen = F.aggregate(
            "bins",
            F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("int").alias("v")),
            lambda state, item: F.struct(
                (state["below"] + item["n"]).alias("below"),
                F.coalesce(
                    state["v"], F.when(100 * (state["below"] + item["n"]) >= percent * F.col("total"), item["v"])
                ).alias("v"),
            ),
        )
        return seen["v"]

    quartiles = counts.select(*group, "feature", quantile(25).alias("low"), quantile(75).alias("high"))
    floors = F.create_map(*(F.lit(x) for name, (_, _, floor, _) in FEATURES.items() for x in (name, floor)))
    spread = F.greatest(F.col("high") - F.col("low"), floors[F.col("feature")])
    limits = quartiles.select(
        *group, "feature", (F.col("low") - REACH * spread).alias("least"), (F.col("high") + REACH * spread).alias("most")
    )
    return limits.groupBy(*group).agg(
        *(
            F.max(F.when(F.col("feature") == name, F.col(side))).alias(f"{side}_{name}")
            for name in FEATURES
            for side in ("least", "most")
        )
    )


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All columns of ``docs`` in struct ``row``, the measures, ``base_failed`` and ``kept``.

    A text of under 20 words, or with over 30 % of its words in repeated 8-word windows, fails the
    base rules. The method rejects what lies beyond a fence of its language and source: too many
    symbols, words too short or long, too many repeated lines or doubled words. NULL and empty
    texts have no words and fail; NULL languages and sources are groups of their own; repeated
    rows are judged alike. An empty table gives an empty result.

    The first pass takes only the cheap measures, for the sketches; the small table of fences is
    stored, so that Spark knows its size when it joins it.
    """
    keys = [F.col(lang).cast("string").alias("q_lang"), F.col(source).cast("string").alias("q_source")]
    limits = stored(fences(text_measures(docs, text, keys)))
    measured = text_measures(docs, text, [F.struct("*").alias("row"), *keys]).alias("m")
    limits = limits.select(
        F.col("q_lang").alias("l_lang"), F.col("q_source").alias("l_source"), *limits.columns[2:]
    )
    judged = measured.join(
        limits, same(F.col("q_lang"), F.col("l_lang")) & same(F.col("q_source"), F.col("l_source")), "left"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    # One number that needs both sides of the join: a filter on it stays above the measures, where
    # separate conditions would be pushed below them and measure every text again.
    faults = failed.cast("int")
    for name, (_, _, _, low) in FEATURES.items():
        faults += (_feature(name) > F.col(f"most_{name}")).cast("int")
        if low:
            faults += (_feature(name) < F.col(f"least_{name}")).cast("int")
    return judged.select(
        "row",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter"),
        failed.alias("base_failed"),
        (faults == 0).alias("kept"),
        F.col("q_lang").alias("group_lang"),
        F.col("q_source").alias("group_source"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with their columns unchanged."""
    return judge(docs).where("kept").select("row.*")
