"""How well the keys of the two extracts match."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketrank.functions import is_nonblank, normalize_key
from docketrank.operators.staging import raw_column


def normalized_keys(raw: DataFrame, key: str) -> DataFrame:
    """The non-blank keys of an extract in comparable form, one row per input row."""
    column = raw_column(key)
    return raw.where(is_nonblank(column)).select(normalize_key(column).alias("wdid"))


def has_column(raw: DataFrame, name: str) -> bool:
    """Exact spelling, unlike Spark's own case-insensitive resolution."""
    return name in raw.columns


def key_match_profile(
    raw_registry: DataFrame, raw_actions: DataFrame, registry_key: str = "wdid", action_key: str = "WDID"
) -> DataFrame:
    """One row: matched and all action rows with a key, unmatched ones, and the match rate.

    Action rows are counted per key before the left join to the distinct registry keys, so the
    join meets each key once on both sides and a key with a third of the log weighs one row.
    """
    for raw, key in ((raw_registry, registry_key), (raw_actions, action_key)):
        if not has_column(raw, key):
            raise ValueError(f"key column {key!r} not found; the extract has {raw.columns}")
    registered = normalized_keys(raw_registry, registry_key).distinct().withColumn("registered", F.lit(True))
    counted = normalized_keys(raw_actions, action_key).groupBy("wdid").agg(F.count("*").alias("actions"))
    joined = counted.join(registered, "wdid", "left")
    totals = joined.agg(
        F.coalesce(F.sum(F.when(F.col("registered"), F.col("actions")).otherwise(0)), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("actions"), F.lit(0)).alias("total"),
    )
    return totals.select(
        "matched",
        "total",
        (F.col("total") - F.col("matched")).alias("unmatched"),
        F.coalesce(F.try_divide("matched", "total"), F.lit(0.0)).alias("match_rate"),
    )


def match_report(
    raw_registry: DataFrame, raw_actions: DataFrame, registry_key: str = "wdid", action_key: str = "WDID"
) -> DataFrame:
    """The join report as numbered lines: column lists of both extracts, then the key match.

    Where a key column is missing the report says so and ends there.
    """
    lines = []
    for title, raw in (("Registry columns", raw_registry), ("Action log columns", raw_actions)):
        lines += [title, *(f"  {name}" for name in raw.columns), ""]
    absent = [key for raw, key in ((raw_registry, registry_key), (raw_actions, action_key)) if not has_column(raw, key)]
    if absent:
        lines += [f"Key column not found: {', '.join(absent)}; no match was computed"]
    else:
        found = key_match_profile(raw_registry, raw_actions, registry_key, action_key).first()
        lines += [
            f"Action rows with a key: {found['total']:,}",
            f"Matched: {found['matched']:,} ({found['match_rate']:.1%})",
            f"Unmatched: {found['unmatched']:,}",
        ]
    return raw_registry.sparkSession.createDataFrame(list(enumerate(lines)), "line int, text string")
