"""The action fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docketrank.functions import outstanding
from docketrank.operators.dimensions import is_formal_type
from docketrank.operators.joins import lookup_join
from docketrank.sources.schemas import INFORMAL_ACTION_TYPES

MONEY_COLUMNS = (
    "total_assessment_amount",
    "liability_amount",
    "liability_paid",
    "project_amount",
    "project_completed",
    "total_paid_completed",
)


def action_formality(action_type: Column, informal: Sequence[str] = INFORMAL_ACTION_TYPES) -> Column:
    """Formality of an action: as its type, but without a type it counts as informal."""
    return F.coalesce(action_type != "", F.lit(False)) & is_formal_type(action_type, informal)


def fact_actions(
    actions: DataFrame, action_types: DataFrame | None = None, informal: Sequence[str] = INFORMAL_ACTION_TYPES
) -> DataFrame:
    """One row per action: formality attached, missing money 0, outstanding floored per action.

    Formality depends on the type alone, so by default it is computed in place and the largest
    table is not joined at all. Pass ``action_types`` to look it up in an edited dimension.
    """
    if action_types is None:
        formal = action_formality(F.col("enforcement_action_type"), informal)
    else:
        actions = lookup_join(actions, action_types, "enforcement_action_type")
        formal = F.coalesce("is_formal", F.lit(False))
    money = {name: F.coalesce(name, F.lit(0.0)) for name in MONEY_COLUMNS}
    return actions.select(
        "enforcement_eid",
        "wdid",
        "reg_measure_id",
        "enforcement_action_type",
        formal.alias("is_formal"),
        "effective_date",
        "adoption_date",
        "termination_date",
        "status",
        "program",
        "program_category",
        "region",
        *(money[name].alias(name) for name in MONEY_COLUMNS),
        outstanding(money["total_assessment_amount"], money["total_paid_completed"]).alias("outstanding_amount"),
        "title",
        "description",
    )
