"""The ranked list: which N facilities come first, and why."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from docketrank.functions import exact_sum, years_before

SUMMARY_FACILITY_COLUMNS = ("facility_name", "region", "county", "place_type")

RANKED_COLUMNS = (
    "rank",
    "wdid",
    "facility_name",
    "region",
    "county",
    "place_type",
    "total_actions",
    "formal_actions",
    "actions_last_3yr",
    "most_recent_action",
    "first_action",
    "total_assessed",
    "total_paid",
    "outstanding_balance",
)


def _recent(fact: DataFrame, latest: date | None, years: int):
    newest = F.lit(latest) if latest else fact.select(F.max("effective_date")).scalar()
    cutoff = years_before(newest, years)
    return F.sum(F.when(F.col("effective_date") >= cutoff, 1).otherwise(0))


def action_summary(fact: DataFrame, latest: date | None = None, recent_years: int = 3) -> DataFrame:
    """Per facility: counts, first and last day, money, and actions of the last years.

    "Recent" counts back from the latest day of the data, found by a scalar subquery over one
    date column; pass ``latest`` to save that read when the day is known.
    """
    return fact.groupBy("wdid").agg(
        F.count("*").alias("total_actions"),
        F.sum(F.when(F.col("is_formal"), 1).otherwise(0)).alias("formal_actions"),
        _recent(fact, latest, recent_years).alias("actions_last_3yr"),
        F.max("effective_date").alias("most_recent_action"),
        F.min("effective_date").alias("first_action"),
        exact_sum(F.col("total_assessment_amount")).alias("total_assessed"),
        exact_sum(F.col("total_paid_completed")).alias("total_paid"),
        exact_sum(F.col("outstanding_amount")).alias("outstanding_balance"),
    )


def facility_summary(
    fact: DataFrame, facilities: DataFrame, latest: date | None = None, recent_years: int = 3
) -> DataFrame:
    """The per-facility summary with the facility's attributes; unknown facilities drop out."""
    return action_summary(fact, latest, recent_years).join(
        facilities.select("wdid", *SUMMARY_FACILITY_COLUMNS), "wdid"
    )


def rank_facilities(summary: DataFrame, top: int = 25) -> DataFrame:
    """The first ``top`` facilities by balance, then actions, then recency, then key.

    The limit comes before the numbering: each task keeps its best ``top`` rows and only those
    are merged, so the unpartitioned window sees ``top`` rows, never the whole table.
    """
    order = (
        F.desc_nulls_last("outstanding_balance"),
        F.desc_nulls_last("total_actions"),
        F.desc_nulls_last("most_recent_action"),
        F.asc_nulls_last("wdid"),
    )
    best = summary.where(F.col("total_actions") > 0).orderBy(*order).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long")).select(*RANKED_COLUMNS)


def priority_facilities(
    fact: DataFrame, facilities: DataFrame, top: int = 25, latest: date | None = None, recent_years: int = 3
) -> DataFrame:
    return rank_facilities(facility_summary(fact, facilities, latest, recent_years), top)
