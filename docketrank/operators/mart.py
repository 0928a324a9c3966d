"""Facility by month mart and the figures read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketrank.functions import calendar_year, exact_sum, exact_total, month_start

FACILITY_COLUMNS = ("facility_name", "agency_name", "region", "county", "city", "place_type", "latitude", "longitude")


def monthly_totals(fact: DataFrame) -> DataFrame:
    """Counts and sums per facility and month of the dated actions."""
    return (
        fact.where(F.col("effective_date").isNotNull())
        .groupBy("wdid", month_start(F.col("effective_date")).alias("month"))
        .agg(
            F.count("*").alias("enforcement_count"),
            F.sum(F.when(F.col("is_formal"), 1).otherwise(0)).alias("formal_count"),
            exact_sum(F.col("total_assessment_amount")).alias("total_assessment"),
            exact_sum(F.col("liability_amount")).alias("total_liability"),
            exact_sum(F.col("liability_paid")).alias("total_paid"),
            exact_sum(F.col("outstanding_amount")).alias("total_outstanding"),
            F.sum(F.when(F.col("status") == "Active", 1).otherwise(0)).alias("active_count"),
        )
    )


def mart_facility_monthly(fact: DataFrame, facilities: DataFrame) -> DataFrame:
    """One row per facility and month of its dated actions.

    Facility attributes depend on the key, so the fact is aggregated by key and month first and
    only the far fewer group rows meet the dimension, at most one per month even for a facility
    that holds a third of all actions.
    """
    return (
        monthly_totals(fact)
        .join(facilities.select("wdid", *FACILITY_COLUMNS), "wdid", "left")
        .select(
            "wdid",
            *FACILITY_COLUMNS,
            "month",
            calendar_year(F.col("month")).alias("year"),
            "enforcement_count",
            "formal_count",
            "total_assessment",
            "total_liability",
            "total_paid",
            "total_outstanding",
            "active_count",
        )
    )


def kpi_totals(mart: DataFrame) -> DataFrame:
    """One row of headline figures over the dated actions."""
    return mart.agg(
        F.countDistinct("wdid").alias("total_facilities"),
        F.sum("enforcement_count").cast("long").alias("total_actions"),
        exact_total(F.col("total_assessment")).alias("total_assessed"),
        exact_total(F.col("total_outstanding")).alias("total_outstanding"),
    )
