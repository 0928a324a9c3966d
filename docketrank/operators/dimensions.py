"""Facility and action-type dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docketrank.sources.schemas import INFORMAL_ACTION_TYPES

# Facility attribute: staged registry column, staged action column, which source comes first.
_REGISTRY_FIRST = {
    "facility_name": ("facility_name", "facility_name"),
    "region": ("facility_region", "region"),
    "place_type": ("place_type", "place_type"),
    "latitude": ("latitude", "latitude"),
    "longitude": ("longitude", "longitude"),
}
_REGISTRY_ONLY = {
    "county": "place_county",
    "city": "place_city",
    "zip_code": "place_zip",
    "place_address": "place_address",
}
_ACTIONS_ONLY = {"agency_name": "agency_name"}

DIM_FACILITY_COLUMNS = (
    "wdid",
    "facility_name",
    "agency_name",
    "region",
    "county",
    "city",
    "zip_code",
    "place_address",
    "place_type",
    "latitude",
    "longitude",
)


def registry_attributes() -> dict[str, str]:
    """Facility attribute -> staged registry column."""
    return {name: pair[0] for name, pair in _REGISTRY_FIRST.items()} | _REGISTRY_ONLY


def action_attributes() -> dict[str, str]:
    """Facility attribute -> staged action column."""
    return {name: pair[1] for name, pair in _REGISTRY_FIRST.items()} | _ACTIONS_ONLY


def _spellings(rows: DataFrame) -> DataFrame:
    """Every row once, by hash.

    They are counted, and the count is asked for, because Spark drops a plain ``distinct`` below
    minima as if it were of no use.
    """
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("_rows")).where("_rows > 0").drop("_rows")


def representative(staged: DataFrame, attributes: dict[str, str], key: str = "wdid") -> DataFrame:
    """One row per key with a non-NULL value per attribute, NULL where the key has none.

    Any value would do; the smallest one makes reruns agree. Spellings are made distinct first, by
    hash: minima of text would need a sort of every staged row, where now only the few spellings
    of a key are sorted. Both steps combine before a shuffle, so a key with a third of all rows
    sends its few spellings per task.
    """
    columns = list(dict.fromkeys(attributes.values()))
    return _spellings(staged.select(key, *columns)).groupBy(key).agg(*(F.min(column).alias(name) for name, column in attributes.items()))


def registry_representative(registry: DataFrame) -> DataFrame:
    return representative(registry, registry_attributes())


def actions_representative(actions: DataFrame) -> DataFrame:
    return representative(actions, action_attributes())


def key_spine(registry: DataFrame, actions: DataFrame, key: str = "wdid") -> DataFrame:
    """Every key of either source once."""
    return registry.select(key).union(actions.select(key)).distinct()


def dim_facility(registry: DataFrame, actions: DataFrame) -> DataFrame:
    """One row per key of either source, the registry's value before the action log's.

    Both sources go through one aggregate side by side instead of two aggregates, a key spine
    and two joins, and Catalyst then knows the key is unique,
    so a reader that needs no attribute drops its join to this table altogether.
    """
    from_registry, from_actions = registry_attributes(), action_attributes()
    registry_side = registry.select("wdid", *(F.col(c).alias(f"registry_{n}") for n, c in from_registry.items()))
    action_side = actions.select("wdid", *(F.col(c).alias(f"actions_{n}") for n, c in from_actions.items()))

    def pick(name: str) -> Column:
        sides = [
            F.min(f"{side}_{name}")
            for side, names in (("registry", from_registry), ("actions", from_actions))
            if name in names
        ]
        return F.coalesce(*sides).alias(name)

    both = _spellings(registry_side.unionByName(action_side, allowMissingColumns=True))
    return both.groupBy("wdid").agg(*(pick(name) for name in DIM_FACILITY_COLUMNS[1:]))


def is_formal_type(action_type: Column, informal: Sequence[str] = INFORMAL_ACTION_TYPES) -> Column:
    """False for the listed types, exact spelling; true for the rest, NULL included."""
    return F.when(action_type.isin(*informal), False).otherwise(True)


def dim_action_type(actions: DataFrame, informal: Sequence[str] = INFORMAL_ACTION_TYPES) -> DataFrame:
    """Every non-blank action type once, with its formality."""
    kind = F.col("enforcement_action_type")
    types = actions.select(kind).where(kind != "").distinct()
    return types.select(kind, is_formal_type(kind, informal).alias("is_formal"))
