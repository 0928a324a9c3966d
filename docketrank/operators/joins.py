"""Joining a large table to a lookup whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unique_lookup(lookup: DataFrame, key: str) -> DataFrame:
    """The lookup, which fails while it runs if some key occurs twice; NULL keys are left out."""
    others = [name for name in lookup.columns if name != key]
    counted = lookup.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("_rows"), *(F.first(name).alias(name) for name in others)
    )
    doubled = F.concat(F.lit(f"lookup key {key} occurs more than once: "), F.col(key).cast("string"))
    checked = F.when(F.col("_rows") > 1, F.raise_error(doubled)).otherwise(F.col(key))
    return counted.select(checked.cast(dict(lookup.dtypes)[key]).alias(key), *others)


def lookup_join(large: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup with one row per key; no row of ``large`` is lost or doubled.

    No job runs while the plan is made. Spark decides from the sizes it meets: a small lookup is
    broadcast and the large side stays where it is; otherwise both sides shuffle by key, and a
    partition that one key makes far larger than the others is split among tasks (adaptive skew
    join), on which a left join allows.
    """
    return large.join(unique_lookup(lookup, key), key, "left")
