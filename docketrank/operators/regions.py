"""Roll-ups of the mart by region."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from docketrank.functions import currency_text, exact_total, map_label
from docketrank.sources.schemas import NO_REGION, OFFICE_LABELS, PARENT_LABELS


def region_label(region: Column) -> Column:
    return map_label(region, OFFICE_LABELS)


def region_parent_label(region: Column) -> Column:
    return map_label(region, PARENT_LABELS)


def rollup_by_label(mart: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Facilities, actions and outstanding money per label; rows without a region stay out.

    The exact facility count is taken on (label, facility) pairs that are combined before they
    are shuffled, so a region with a third of the mart does not land in one task.
    """
    in_region = mart.where(F.col("region").isNotNull() & (F.col("region") != NO_REGION))
    return in_region.groupBy(map_label(F.col("region"), labels).alias("region")).agg(
        F.countDistinct("wdid").alias("facilities"),
        F.sum("enforcement_count").cast("long").alias("actions"),
        exact_total(F.col("total_outstanding")).alias("outstanding"),
    )


def most_actions_first(rollup: DataFrame) -> DataFrame:
    """Order a roll-up for a report; at most one row per region, so one task sorts it."""
    return rollup.repartition(1).sortWithinPartitions(F.desc_nulls_last("actions"), F.asc_nulls_last("region"))


def region_rollup(mart: DataFrame) -> DataFrame:
    """By parent region: the sub-offices of regions 5 and 6 count together."""
    return most_actions_first(rollup_by_label(mart, PARENT_LABELS))


def suboffice_rollup(mart: DataFrame) -> DataFrame:
    """By office."""
    return most_actions_first(rollup_by_label(mart, OFFICE_LABELS))


def region_display(rollup: DataFrame) -> DataFrame:
    """A roll-up with report headings and currency text, order kept."""
    return rollup.select(
        F.col("region").alias("Region"),
        F.col("facilities").alias("Facilities"),
        F.col("actions").alias("Total actions"),
        currency_text(F.col("outstanding")).alias("Outstanding balance"),
    )
