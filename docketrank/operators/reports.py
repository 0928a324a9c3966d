"""Report forms of the ranked list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketrank.functions import currency_text, date_text
from docketrank.operators.regions import region_label


def in_rank_order(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy(F.asc_nulls_last("rank"))


def priority_display(ranked: DataFrame) -> DataFrame:
    """Eleven columns with report headings, office labels, currency and date text."""
    return in_rank_order(ranked).select(
        F.col("rank").alias("Rank"),
        F.col("facility_name").alias("Facility"),
        region_label(F.col("region")).alias("Region"),
        F.col("county").alias("County"),
        F.col("total_actions").alias("Total actions"),
        F.col("formal_actions").alias("Formal actions"),
        F.col("actions_last_3yr").alias("Actions (last 3yr)"),
        date_text(F.col("most_recent_action")).alias("Most recent"),
        currency_text(F.col("total_assessed")).alias("Assessed"),
        currency_text(F.col("total_paid")).alias("Paid"),
        currency_text(F.col("outstanding_balance")).alias("Outstanding"),
    )


def priority_bar_order(ranked: DataFrame) -> DataFrame:
    """Smallest balance first, as a horizontal bar chart is drawn from the bottom."""
    return ranked.orderBy(F.asc_nulls_last("outstanding_balance"), F.desc_nulls_last("rank"))
