"""The query catalogue: one entry per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketrank import functions as fx, operators as ops
from docketrank.functions.dates import ACTION_DATE_FLOOR
from docketrank.plans import refresh
from docketrank.plans.layers import Layers
from docketrank.session import apply_settings
from docketrank.sources import csv_lines, csv_records, parse_csv_records, ranked_csv_lines
from docketrank.sources.schemas import ACTION_COLUMNS, OFFICE_LABELS, PARENT_LABELS, REGISTRY_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]


def _order_number() -> Column:
    return F.col("ORDER / RESOLUTION NUMBER").alias("order_number")


# --- one cleaning function over every raw row ---------------------------------------------


def normalize_key(layers: Layers) -> DataFrame:
    return layers.raw_actions.select(_order_number(), fx.normalize_key(F.col("WDID")).alias("wdid"))


def nonblank_key(layers: Layers) -> DataFrame:
    return layers.raw_actions.where(fx.is_nonblank(F.col("WDID"))).select(
        _order_number(), fx.trim_text(F.col("WDID")).alias("wdid_text")
    )


def parse_money(layers: Layers) -> DataFrame:
    return layers.raw_actions.select(
        _order_number(),
        fx.parse_money(F.col("TOTAL ASSESSMENT AMOUNT")).alias("total_assessment_amount"),
        fx.parse_money(F.col("INITIAL ASSESSED AMOUNT")).alias("initial_assessed_amount"),
        fx.parse_money(F.col("TOTAL $ PAID/COMPLETED AMOUNT")).alias("total_paid_completed"),
    )


def parse_double(layers: Layers) -> DataFrame:
    return layers.raw_actions.select(
        _order_number(),
        fx.parse_double(F.col("PLACE LATITUDE")).alias("latitude"),
        fx.parse_double(F.col("PLACE LONGITUDE")).alias("longitude"),
    )


def parse_date_registry(layers: Layers) -> DataFrame:
    """Review dates have two-digit years, here read literally; as text, since year 16 is out of
    the range of many date types on the reading side."""
    return layers.raw_registry.select(
        fx.normalize_key(F.col("wdid")).alias("wdid"),
        F.col("reg_measure_id"),
        fx.parse_date(F.col("effective_date")).alias("effective_date"),
        fx.parse_date(F.col("termination_date")).alias("termination_date"),
        fx.parse_date(F.col("adoption_date")).alias("adoption_date"),
        fx.date_text(fx.parse_date(F.col("expiration_review_date"))).alias("review_date_text"),
    )


def parse_date_actions(layers: Layers) -> DataFrame:
    effective = F.col("EFFECTIVE DATE")
    return layers.raw_actions.select(
        _order_number(),
        fx.parse_date(effective, ACTION_DATE_FLOOR).alias("effective_date"),
        fx.parse_date(effective, ACTION_DATE_FLOOR, two_digit_year="pivot").alias("effective_date_pivot"),
        fx.parse_date(F.col("ADOPTION / ISSUANCE DATE"), ACTION_DATE_FLOOR).alias("adoption_date"),
        fx.parse_date(F.col("TERMINATION DATE"), ACTION_DATE_FLOOR).alias("termination_date"),
    )


def floor_date(layers: Layers) -> DataFrame:
    return layers.raw_actions.select(
        _order_number(), fx.floor_date(fx.parse_date(F.col("EFFECTIVE DATE"))).alias("floored_date")
    )


def action_formality(layers: Layers) -> DataFrame:
    kind = fx.trim_text(F.col("ENFORCEMENT ACTION TYPE"))
    return layers.raw_actions.select(
        _order_number(), kind.alias("action_type"), ops.action_formality(kind).alias("is_formal")
    )


def outstanding_per_action(layers: Layers) -> DataFrame:
    assessed = F.coalesce("total_assessment_amount", F.lit(0.0))
    paid = F.coalesce("total_paid_completed", F.lit(0.0))
    return layers.actions.select(
        F.col("order_resolution_number").alias("order_number"),
        fx.outstanding(assessed, paid).alias("outstanding_amount"),
    )


def month_year(layers: Layers) -> DataFrame:
    day = F.col("effective_date")
    return layers.actions.where(day.isNotNull()).select(
        F.col("order_resolution_number").alias("order_number"),
        fx.month_start(day).alias("month"),
        fx.calendar_year(day).alias("year"),
    )


def region_label(layers: Layers) -> DataFrame:
    region = F.col("region")
    return layers.facilities.select("wdid", region, ops.region_label(region).alias("label"))


def region_parent_label(layers: Layers) -> DataFrame:
    region = F.col("region")
    return layers.facilities.select("wdid", region, ops.region_parent_label(region).alias("label"))


# --- layers -------------------------------------------------------------------------------


def stage_registry(layers: Layers) -> DataFrame:
    return layers.registry


def stage_actions(layers: Layers) -> DataFrame:
    return layers.actions


def csv_round_trip(layers: Layers) -> DataFrame:
    """The whole registry written as CSV records and read back strictly, then staged."""
    return ops.stage_registry(parse_csv_records(csv_records(layers.raw_registry), REGISTRY_COLUMNS))


def csv_tolerant_round_trip(layers: Layers) -> DataFrame:
    """The whole action log as CSV records with a short and a long one beside each, then staged.

    The short ones must go, the surplus of the long ones too; the rest comes back as it was.
    """
    records = csv_records(layers.raw_actions)
    kinds = F.array(F.col("record"), F.concat("record", F.lit(",surplus")), F.lit("short,record"))
    read = parse_csv_records(records.select(F.explode(kinds).alias("record")), ACTION_COLUMNS, tolerant=True)
    return ops.stage_actions(read.distinct())


def csv_repair_round_trip(layers: Layers) -> DataFrame:
    """The whole action log as CSV records, each behind a line whose quote opens and doesn't close.

    Every such pair looks like one record; the lines must come back, those without a key to go in staging.
    """
    records = csv_records(layers.raw_actions)
    stray = F.lit('"12 outfall' + "," * (len(ACTION_COLUMNS) - 1))
    swallowed = records.select(F.concat(stray, F.lit("\n"), "record").alias("record"))
    return ops.stage_actions(parse_csv_records(swallowed, ACTION_COLUMNS, tolerant=True))


def display_texts(layers: Layers) -> DataFrame:
    """Report texts of the mart's sums that no other report shows."""
    totals = layers.mart.groupBy("wdid").agg(F.sum("enforcement_count").cast("long").alias("actions"))
    return totals.select(
        "wdid",
        fx.millions_text(F.col("actions") * F.lit(1_000_000.0)).alias("millions"),
        fx.count_text(F.col("actions") * 1000).alias("thousands"),
        fx.percent_text(F.col("actions") / F.lit(8.0)).alias("eighths"),
    )


def key_spine(layers: Layers) -> DataFrame:
    return ops.key_spine(layers.registry, layers.actions)


def registry_representative(layers: Layers) -> DataFrame:
    return ops.registry_representative(layers.registry)


def actions_representative(layers: Layers) -> DataFrame:
    return ops.actions_representative(layers.actions)


def dim_facility(layers: Layers) -> DataFrame:
    return layers.facilities


def dim_action_type(layers: Layers) -> DataFrame:
    return layers.action_types


def fact_actions(layers: Layers) -> DataFrame:
    return layers.fact


def fact_actions_by_lookup(layers: Layers) -> DataFrame:
    """Formality through the join to the action-type dimension."""
    return ops.fact_actions(layers.actions, layers.action_types)


def mart_monthly(layers: Layers) -> DataFrame:
    return layers.mart


def mart_without_year(layers: Layers) -> DataFrame:
    return layers.mart.drop("year")


def _two_loads(layers: Layers) -> DataFrame:
    """Daily totals of the log loaded in two parts, each staged and summed up by itself, then merged."""
    late = F.coalesce(F.pmod(F.xxhash64("ORDER / RESOLUTION NUMBER"), F.lit(2)) == 1, F.lit(False))
    parts = (layers.raw_actions.where(~late), layers.raw_actions.where(late))
    return ops.merge_totals(*(ops.daily_totals(ops.fact_actions(ops.stage_actions(part))) for part in parts))


def mart_in_two_loads(layers: Layers) -> DataFrame:
    return ops.mart_from_daily(_two_loads(layers), layers.facilities)


def summary_in_two_loads(layers: Layers) -> DataFrame:
    return ops.summary_from_daily(_two_loads(layers), layers.facilities)


# --- answers and reports ------------------------------------------------------------------


def formal_counts(layers: Layers) -> DataFrame:
    return ops.action_summary(layers.fact).select("wdid", "total_actions", "formal_actions")


def recent_window_count(layers: Layers) -> DataFrame:
    return ops.action_summary(layers.fact).select("wdid", "actions_last_3yr")


def facility_summary(layers: Layers) -> DataFrame:
    return ops.facility_summary(layers.fact, layers.facilities)


def priority(layers: Layers) -> DataFrame:
    return layers.ranked


def priority_read(layers: Layers) -> DataFrame:
    return ops.in_rank_order(layers.ranked)


def priority_display(layers: Layers) -> DataFrame:
    return ops.priority_display(layers.ranked)


def priority_bar_order(layers: Layers) -> DataFrame:
    return ops.priority_bar_order(layers.ranked).select("facility_name", "outstanding_balance")


def kpi_totals(layers: Layers) -> DataFrame:
    return ops.kpi_totals(layers.mart)


def region_rollup(layers: Layers) -> DataFrame:
    return ops.region_rollup(layers.mart)


def suboffice_rollup(layers: Layers) -> DataFrame:
    return ops.suboffice_rollup(layers.mart)


def _bitmaps(layers: Layers) -> DataFrame:
    return ops.month_bitmaps(layers.mart, ops.facility_numbers(layers.facilities))


def kpis_by_bitmaps(layers: Layers) -> DataFrame:
    return ops.kpis_from_bitmaps(_bitmaps(layers))


def region_rollup_by_bitmaps(layers: Layers) -> DataFrame:
    return ops.rollup_from_bitmaps(_bitmaps(layers), PARENT_LABELS)


def suboffice_rollup_by_bitmaps(layers: Layers) -> DataFrame:
    return ops.rollup_from_bitmaps(_bitmaps(layers), OFFICE_LABELS)


def region_display(layers: Layers) -> DataFrame:
    return ops.region_display(ops.suboffice_rollup(layers.mart))


def mart_export_lines(layers: Layers) -> DataFrame:
    """The mart's export, line by line."""
    return csv_lines(layers.mart)


def priority_export_lines(layers: Layers) -> DataFrame:
    """The ranked list's export with the number of each line."""
    return ranked_csv_lines(layers.ranked)


# --- profiles and checks ------------------------------------------------------------------


def key_match_profile(layers: Layers) -> DataFrame:
    return ops.key_match_profile(layers.raw_registry, layers.raw_actions)


def layer_row_counts(layers: Layers) -> DataFrame:
    return ops.layer_row_counts(
        {
            refresh.RAW_REGISTRY: layers.raw_registry,
            refresh.RAW_ACTIONS: layers.raw_actions,
            refresh.STAGED_REGISTRY: layers.registry,
            refresh.STAGED_ACTIONS: layers.actions,
            refresh.FACILITIES: layers.facilities,
            refresh.ACTION_TYPES: layers.action_types,
            refresh.FACT: layers.fact,
            refresh.MART: layers.mart,
            refresh.RANKED: layers.ranked,
        }
    )


def schema_snapshot(layers: Layers) -> DataFrame:
    """What the load step reports: columns and row count of both raw tables."""
    tables = {refresh.RAW_REGISTRY: layers.raw_registry, refresh.RAW_ACTIONS: layers.raw_actions}
    counts = ops.layer_row_counts(tables).withColumnRenamed("layer", "table")
    return ops.schema_snapshot(layers.raw_actions.sparkSession, tables).join(counts, "table")


def quality_report(layers: Layers) -> DataFrame:
    return ops.quality_report(layers.raw_actions, layers.registry, layers.actions, layers.fact, layers.facilities)


def duplicate_ids(layers: Layers) -> DataFrame:
    return ops.duplicate_ids(layers.fact)


_QUERIES = (
    normalize_key,
    nonblank_key,
    parse_money,
    parse_double,
    parse_date_registry,
    parse_date_actions,
    floor_date,
    action_formality,
    outstanding_per_action,
    month_year,
    region_label,
    region_parent_label,
    stage_registry,
    stage_actions,
    csv_round_trip,
    csv_tolerant_round_trip,
    csv_repair_round_trip,
    display_texts,
    key_spine,
    registry_representative,
    actions_representative,
    dim_facility,
    dim_action_type,
    fact_actions,
    fact_actions_by_lookup,
    mart_monthly,
    mart_without_year,
    mart_in_two_loads,
    summary_in_two_loads,
    formal_counts,
    recent_window_count,
    facility_summary,
    priority,
    priority_read,
    priority_display,
    priority_bar_order,
    kpi_totals,
    region_rollup,
    suboffice_rollup,
    kpis_by_bitmaps,
    region_rollup_by_bitmaps,
    suboffice_rollup_by_bitmaps,
    region_display,
    mart_export_lines,
    priority_export_lines,
    key_match_profile,
    layer_row_counts,
    schema_snapshot,
    quality_report,
    duplicate_ids,
)


def _over_tables(build: Callable[[Layers], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(Layers.from_tables(apply_settings(spark), folder))

    query.__name__ = build.__name__
    query.__doc__ = build.__doc__
    return query


# Queries on any pair of raw extracts, and on the extracts derived from the tables of a folder.
BUILDS: dict[str, Callable[[Layers], DataFrame]] = {build.__name__: build for build in _QUERIES}
CATALOGUE: dict[str, Query] = {build.__name__: _over_tables(build) for build in _QUERIES}
