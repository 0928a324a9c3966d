"""Totals per facility and day: small, mergeable, and enough for the mart and the ranked list.

Parts of the log can be loaded apart and their totals put together later; mart and ranking then read
totals, of which a facility has a row a day at most, and not the log again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from docketrank.functions import calendar_year, exact_cents, month_start, years_before
from docketrank.operators.mart import FACILITY_COLUMNS
from docketrank.operators.ranking import SUMMARY_FACILITY_COLUMNS, rank_facilities

_COUNTS = ("enforcement_count", "formal_count", "active_count")
_MONEY = ("total_assessment_amount", "liability_amount", "liability_paid", "total_paid_completed", "outstanding_amount")


def daily_totals(fact: DataFrame) -> DataFrame:
    """Counts and exact sums of money per facility and day; undated actions have a NULL day.

    Combined by task before anything moves, so a facility with a third of the log is a few rows.
    """
    return fact.groupBy("wdid", F.col("effective_date").alias("day")).agg(
        F.count("*").alias("enforcement_count"),
        F.count_if(F.col("is_formal")).alias("formal_count"),
        F.count_if(F.col("status") == "Active").alias("active_count"),
        *(exact_cents(F.col(name)).alias(name) for name in _MONEY),
    )


def merge_totals(*parts: DataFrame) -> DataFrame:
    """Totals of several parts of a log as those of the whole; each action is in one part."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("wdid", "day").agg(*(F.sum(name).alias(name) for name in (*_COUNTS, *_MONEY)))


def with_year(totals: DataFrame) -> DataFrame:
    """Totals with the calendar year of the day, by which they are stored."""
    return totals.withColumn("year", calendar_year(F.col("day")))


def mart_from_daily(totals: DataFrame, facilities: DataFrame) -> DataFrame:
    """The facility by month mart; over totals and facilities bucketed by key nothing is shuffled."""
    months = (
        totals.where(F.col("day").isNotNull())
        .groupBy("wdid", month_start(F.col("day")).alias("month"))
        .agg(*(F.sum(name).alias(name) for name in (*_COUNTS, *_MONEY)))
    )
    return months.join(facilities.select("wdid", *FACILITY_COLUMNS), "wdid", "left").select(
        "wdid",
        *FACILITY_COLUMNS,
        "month",
        calendar_year(F.col("month")).alias("year"),
        "enforcement_count",
        "formal_count",
        F.col("total_assessment_amount").cast("double").alias("total_assessment"),
        F.col("liability_amount").cast("double").alias("total_liability"),
        F.col("liability_paid").cast("double").alias("total_paid"),
        F.col("outstanding_amount").cast("double").alias("total_outstanding"),
        "active_count",
    )


def summary_from_daily(
    totals: DataFrame, facilities: DataFrame, latest: date | None = None, recent_years: int = 3
) -> DataFrame:
    """The per-facility summary, undated actions included; unknown facilities drop out."""
    newest = F.lit(latest) if latest else totals.select(F.max("day")).scalar()
    recent = F.col("day") >= years_before(newest, recent_years)
    by_facility = totals.groupBy("wdid").agg(
        F.sum("enforcement_count").alias("total_actions"),
        F.sum("formal_count").alias("formal_actions"),
        F.sum(F.when(recent, F.col("enforcement_count")).otherwise(0)).alias("actions_last_3yr"),
        F.max("day").alias("most_recent_action"),
        F.min("day").alias("first_action"),
        F.sum("total_assessment_amount").cast("double").alias("total_assessed"),
        F.sum("total_paid_completed").cast("double").alias("total_paid"),
        F.sum("outstanding_amount").cast("double").alias("outstanding_balance"),
    )
    return by_facility.join(facilities.select("wdid", *SUMMARY_FACILITY_COLUMNS), "wdid")


def priority_from_daily(
    totals: DataFrame, facilities: DataFrame, top: int = 25, latest: date | None = None, recent_years: int = 3
) -> DataFrame:
    return rank_facilities(summary_from_daily(totals, facilities, latest, recent_years), top)
