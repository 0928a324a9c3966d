"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from docketrank import operators as ops
from docketrank.plans.catalogue import CATALOGUE
from docketrank.plans.layers import Layers
from docketrank.session import apply_settings


@pytest.fixture(scope="module")
def layers(spark, tables) -> Layers:
    return Layers.from_tables(spark, tables)


@pytest.fixture(scope="module")
def landed(spark, layers, tmp_path_factory):
    """Staged layers as written tables, the way a refresh reads them."""
    folder = str(tmp_path_factory.mktemp("landed"))
    layers.registry.write.parquet(f"{folder}/registry")
    layers.actions.write.parquet(f"{folder}/actions")
    registry, actions = spark.read.parquet(f"{folder}/registry"), spark.read.parquet(f"{folder}/actions")
    ops.fact_actions(actions).write.parquet(f"{folder}/fact")
    ops.dim_facility(registry, actions).write.parquet(f"{folder}/facilities")
    return {
        "registry": registry,
        "actions": actions,
        "fact": spark.read.parquet(f"{folder}/fact"),
        "facilities": spark.read.parquet(f"{folder}/facilities"),
    }


def exchanges(text: str, kind: str = "Exchange") -> int:
    return len(re.findall(rf"^[\s:+*()\d-]*{kind} ", text, flags=re.MULTILINE))


def test_staging_shuffles_nothing_and_reads_only_what_is_asked(spark, layers, plan, tmp_path):
    layers.raw_actions.write.parquet(str(tmp_path / "raw"))
    staged = ops.stage_actions(spark.read.parquet(str(tmp_path / "raw")))
    assert exchanges(plan(staged)) == 0
    [schema] = re.findall(r"ReadSchema: (struct<.*?>)", plan(staged.select("wdid", "liability_paid")))
    assert schema.count(":string") == 2 and "WDID" in schema and "LIABILITY $ PAID" in schema


def test_no_python_and_no_nested_loops_anywhere(spark, tables, plan):
    for name, query in CATALOGUE.items():
        text = plan(query(spark, tables))
        for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert unwanted not in text, (name, unwanted)


def test_ranking_merges_only_the_best_rows_of_each_task(layers, plan):
    text = plan(layers.ranked)
    assert "TakeOrderedAndProject(limit=25" in text
    window = text.index("Window [row_number")
    assert window < text.index("TakeOrderedAndProject")
    assert "Exchange SinglePartition" not in text[: text.index("TakeOrderedAndProject")]


def test_fact_needs_no_join_and_no_shuffle(landed, plan):
    text = plan(ops.fact_actions(landed["actions"]))
    assert exchanges(text) == 0 and "Join" not in text


def test_facility_dimension_shrinks_by_hash_before_anything_is_sorted(landed, plan):
    text = plan(ops.dim_facility(landed["registry"], landed["actions"]))
    assert exchanges(text) == 2 and "Join" not in text
    first = text.rindex("Exchange ")  # the plan is printed from the top: the last exchange runs first
    assert "Sort" not in text[first:] and "HashAggregate" in text[first:]


def test_building_the_lookup_query_runs_no_job(spark, tables):
    """None but those that read the files' schemas, which staging needs as well."""
    jobs = {}
    for name in ("stage_actions", "fact_actions_by_lookup"):
        spark.sparkContext.setJobGroup(f"building {name}", name)
        CATALOGUE[name](spark, tables)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs["fact_actions_by_lookup"] == jobs["stage_actions"]


def test_quality_report_scans_the_log_four_times(landed, plan):
    raw = landed["actions"].withColumnRenamed("wdid", "WDID")
    text = plan(ops.quality_report(raw, landed["registry"], landed["actions"], landed["fact"], landed["facilities"]))
    assert text.count("FileScan") <= 5  # four of them of the log or the fact


def test_mart_aggregates_before_it_joins(landed, plan):
    text = plan(ops.mart_facility_monthly(landed["fact"], landed["facilities"]))
    join, partial = text.index("Join"), text.index("partial_count")
    assert join < partial
    assert "IsNotNull(effective_date)" in text[text.index("PushedFilters") :]
    assert "title" not in text and "description" not in text


def test_headline_figures_skip_the_dimension(layers, plan):
    text = plan(ops.kpi_totals(layers.mart))
    assert "customer.parquet" not in text


def test_region_rollup_never_gathers_a_region(landed, plan):
    mart = ops.mart_facility_monthly(landed["fact"], landed["facilities"])
    text = plan(ops.rollup_by_label(mart, {"1": "one"}))
    assert "partial_count(distinct wdid" in text or "partial_count(wdid" in text
    assert "Exchange SinglePartition" not in text


def test_key_match_counts_before_it_joins(layers, plan):
    text = plan(ops.key_match_profile(layers.raw_registry, layers.raw_actions))
    join = text.index("Join")
    assert text.index("partial_count", join) > join


def test_sums_stay_in_the_hash_table(landed, plan):
    for df in (ops.action_summary(landed["fact"]), ops.monthly_totals(landed["fact"])):
        text = plan(df)
        assert "HashAggregate" in text and "SortAggregate" not in text


def test_totals_bucketed_by_key_need_no_shuffle(spark, landed, plan):
    """From totals and facilities in the catalog, the mart and the summary are made where the rows lie."""
    from docketrank.sources import replace_table

    spark.sql("CREATE DATABASE IF NOT EXISTS docketrank_buckets")
    try:
        replace_table(ops.daily_totals(landed["fact"]), "docketrank_buckets.totals", bucket_by="wdid", buckets=4)
        replace_table(landed["facilities"], "docketrank_buckets.facilities", bucket_by="wdid", buckets=4)
        totals, facilities = spark.table("docketrank_buckets.totals"), spark.table("docketrank_buckets.facilities")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        mart = ops.mart_from_daily(totals, facilities)
        assert exchanges(plan(mart)) == 0 and "SortMergeJoin" in plan(mart)
        replace_table(mart, "docketrank_buckets.mart", ["year"], bucket_by="wdid", buckets=4)
        by_year = spark.table("docketrank_buckets.mart").where("year = 1995").select("wdid")
        assert "PartitionFilters: [isnotnull(year" in plan(by_year)
        latest = totals.agg({"day": "max"}).first()[0]
        assert exchanges(plan(ops.summary_from_daily(totals, facilities, latest))) == 0
        assert exchanges(plan(ops.priority_from_daily(totals, facilities, latest=latest))) == 0
        assert "Exchange" not in plan(spark.table("docketrank_buckets.mart").groupBy("wdid").sum("enforcement_count"))
        same = ops.mart_facility_monthly(landed["fact"], landed["facilities"])
        assert mart.exceptAll(same).count() == 0 and same.count() == mart.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE docketrank_buckets CASCADE")


def test_bitmaps_roll_up_by_month(spark, landed, plan):
    """Any months can be counted from bitmaps, and no facility key moves for it."""
    mart = ops.mart_facility_monthly(landed["fact"], landed["facilities"])
    bitmaps = ops.month_bitmaps(mart, ops.facility_numbers(landed["facilities"], parts=3)).cache()
    some = "month >= '1994-01-01' AND month < '1995-07-01'"
    wanted = ops.rollup_by_label(mart.where(some), {"5S": "five", "5F": "five"})
    found = ops.rollup_from_bitmaps(bitmaps.where(some), {"5S": "five", "5F": "five"})
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert "wdid" not in plan(ops.kpis_from_bitmaps(bitmaps)).split("InMemoryRelation")[0]
    bitmaps.unpersist()
    numbers = [r["facility_no"] for r in ops.facility_numbers(landed["facilities"], parts=3).collect()]
    assert len(set(numbers)) == len(numbers) == landed["facilities"].count() and min(numbers) > 0


def test_parts_of_totals_and_their_merge_share_no_task(spark, landed, plan):
    apply_settings(spark)
    late = F.pmod(F.xxhash64("enforcement_eid"), F.lit(2)) == 1
    parts = (ops.daily_totals(landed["fact"].where(part)) for part in (~late, late))
    merged = plan(ops.merge_totals(*parts))
    # Above the union the rows are combined once, then shuffled.
    above = merged[: re.search(r"^[\s:+*()\d-]*Union", merged, flags=re.MULTILINE).start()]
    assert exchanges(above) == 1 and above.rindex("Exchange") > above.index("HashAggregate")


def test_no_filter_parses_a_record_again(spark, tables, plan):
    for name in ("csv_tolerant_round_trip", "csv_repair_round_trip"):
        lines = plan(CATALOGUE[name](spark, tables)).splitlines()
        filters = [line for line in lines if re.match(r"[\s:+*()\d-]*Filter ", line)]
        assert filters and not any("from_csv" in line for line in filters), name
