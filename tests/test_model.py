from __future__ import annotations

from datetime import date

import pytest

from docketrank import operators as ops
from docketrank.operators.staging import stage
from docketrank.sources.schemas import (
    ACTION_COLUMNS,
    INFORMAL_ACTION_TYPES,
    OFFICE_LABELS,
    PARENT_LABELS,
    REGISTRY_COLUMNS,
    Staged,
    text_schema,
)


def frame(spark, columns, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], text_schema(columns)).repartition(3)


@pytest.fixture
def actions(spark):
    return lambda rows: frame(spark, ACTION_COLUMNS, rows)


@pytest.fixture
def registry(spark):
    return lambda rows: frame(spark, REGISTRY_COLUMNS, rows)


def by_key(df, key="wdid"):
    return {row[key]: row.asDict() for row in df.collect()}


def action(key, day="1/1/2019", assessed="0", paid="0", kind="Admin Civil Liability", **more):
    return {
        "WDID": key,
        "EFFECTIVE DATE": day,
        "TOTAL ASSESSMENT AMOUNT": assessed,
        "TOTAL $ PAID/COMPLETED AMOUNT": paid,
        "ENFORCEMENT ACTION TYPE": kind,
        **more,
    }


def test_staging_contract(registry, actions):
    assert len(ops.stage_registry(registry([])).columns) == 18
    assert len(ops.stage_actions(actions([])).columns) == 29
    rows = ops.stage_actions(actions([action(" ab1 "), action("  "), action(None), action("x")])).collect()
    assert sorted(r["wdid"] for r in rows) == ["AB1", "X"]


def test_staging_by_a_users_own_columns(spark):
    raw = spark.createDataFrame([(" a ", "$5", "2020-01-02"), ("", "$6", "")], "`my key` string, amount string, d string")
    columns = [Staged("k", "my key", "key"), Staged("v", "amount", "money"), Staged("d", "d", "date")]
    assert [tuple(r) for r in stage(raw, columns).collect()] == [("A", 5.0, date(2020, 1, 2))]


def test_representative_takes_a_value_that_is_not_null(spark):
    staged = spark.createDataFrame([("A", None), ("A", ""), ("A", "X"), ("B", None)], "wdid string, name string")
    got = by_key(ops.representative(staged, {"name": "name"}))
    assert got["A"]["name"] == "" and got["B"]["name"] is None


def test_facility_precedence(registry, actions):
    registered = registry(
        [
            {"wdid": "both", "facility_region": "1", "facility_name": "R", "place_county": "C"},
            {"wdid": "blank", "facility_region": ""},
            {"wdid": "only-r", "facility_region": "NA"},
            {"wdid": "gap", "facility_region": None},
        ]
    )
    log = actions(
        [
            action("both", REGION="2", **{"FACILITY NAME": "A", "AGENCY NAME": "G"}),
            action("blank", REGION="2"),
            action("gap", REGION="2"),
            action("only-a", REGION="3"),
        ]
    )
    staged = ops.stage_registry(registered), ops.stage_actions(log)
    got = by_key(ops.dim_facility(*staged))
    assert set(got) == {r["wdid"] for r in ops.key_spine(*staged).collect()}
    assert (got["BOTH"]["region"], got["BOTH"]["facility_name"]) == ("1", "R")
    assert (got["BOTH"]["agency_name"], got["BOTH"]["county"]) == ("G", "C")
    assert {k: v["region"] for k, v in got.items()} == {
        "BOTH": "1", "BLANK": "", "ONLY-R": "NA", "GAP": "2", "ONLY-A": "3",
    }


def test_formality(actions):
    kinds = [*INFORMAL_ACTION_TYPES, INFORMAL_ACTION_TYPES[0].lower(), "", None, "Time Schedule Order"]
    staged = ops.stage_actions(actions([action(f"k{i}", kind=kind) for i, kind in enumerate(kinds)]))
    expected = {f"K{i}": False for i in range(6)} | {"K6": True, "K7": False, "K8": False, "K9": True}
    dimension = ops.dim_action_type(staged)
    assert dimension.count() == 8
    for fact in (ops.fact_actions(staged), ops.fact_actions(staged, dimension)):
        assert {k: v["is_formal"] for k, v in by_key(fact).items()} == expected


def test_lookup_join_keeps_every_row(spark):
    large = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'k' || id % 50 END AS k")
    lookup = spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(40)), (None, 7), (None, 8)], "k string, v int")
    joined = ops.lookup_join(large, lookup, "k")
    assert joined.columns == ["k", "id", "v"]
    plain = {r["id"]: r["v"] for r in large.join(lookup, "k", "left").collect()}
    assert {r["id"]: r["v"] for r in joined.collect()} == plain and len(plain) == 1000


def test_lookup_with_a_doubled_key_fails(spark):
    lookup = spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int")
    with pytest.raises(Exception, match="more than once: a"):
        ops.lookup_join(spark.createDataFrame([("a",)], "k string"), lookup, "k").collect()


def test_outstanding_is_floored_per_action(registry, actions):
    staged = ops.stage_actions(actions([action("a", assessed="$100"), action("a", paid="$60")]))
    facilities = ops.dim_facility(ops.stage_registry(registry([])), staged)
    row = ops.priority_facilities(ops.fact_actions(staged), facilities).first()
    assert (row["total_assessed"], row["total_paid"], row["outstanding_balance"]) == (100.0, 60.0, 100.0)


def test_recent_window_is_inclusive_and_clamps(actions):
    days = ["2020-02-29", "2017-02-27", "2017-02-28", None, "12/29/16"]
    fact = ops.fact_actions(ops.stage_actions(actions([action("a", day) for day in days])))
    assert ops.action_summary(fact).first()["actions_last_3yr"] == 2
    assert ops.action_summary(fact, latest=date(2020, 2, 27)).first()["actions_last_3yr"] == 3


def test_ranking_order_ties_and_limit(registry, actions):
    rows = [action("balance", assessed="900")]
    rows += [action("count", assessed="300"), action("count", assessed="200")]
    rows += [action("recent", "2/1/2019", "500"), action("older", "1/1/2019", "500")]
    rows += [action("undated", "N/A", "500"), action("tie-b", "1/1/2018", "500"), action("tie-a", "1/1/2018", "500")]
    rows += [action(f"small{i:02d}", assessed="1") for i in range(19)]
    staged = ops.stage_actions(actions(rows))
    facilities = ops.dim_facility(ops.stage_registry(registry([])), staged)
    fact = ops.fact_actions(staged)
    got = sorted(ops.priority_facilities(fact, facilities).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, 26))
    assert [r["wdid"] for r in got[:7]] == ["BALANCE", "COUNT", "RECENT", "OLDER", "TIE-A", "TIE-B", "UNDATED"]
    assert [r["wdid"] for r in got[7:]] == [f"SMALL{i:02d}" for i in range(18)]
    undated = got[6]
    assert (undated["most_recent_action"], undated["first_action"], undated["actions_last_3yr"]) == (None, None, 0)
    assert ops.priority_facilities(fact, facilities, top=3).count() == 3


def test_mart_drops_undated_and_keeps_two_paid_columns_apart(registry, actions):
    log = [
        action("a", "1/5/2019", "100", "30", STATUS="Active", **{"LIABILITY $ PAID": "7"}),
        action("a", "1/25/2019", "50", "80", kind="Oral Communication", STATUS="active"),
        action("a", "12/29/16", "1000"),
    ]
    staged = ops.stage_actions(actions(log))
    mart = ops.mart_facility_monthly(
        ops.fact_actions(staged), ops.dim_facility(ops.stage_registry(registry([])), staged)
    )
    assert len(mart.columns) == 18
    [row] = mart.collect()
    assert (row["month"], row["year"], row["enforcement_count"], row["formal_count"]) == (date(2019, 1, 1), 2019, 2, 1)
    assert (row["total_assessment"], row["total_paid"], row["total_outstanding"]) == (150.0, 7.0, 70.0)
    assert row["active_count"] == 1


def test_region_rollups(spark):
    regions = ["5S", "5F", "5R", "6A", "6B", "NA", None, "", "XX", "1"]
    rows = [(f"w{i}", region, i + 1, 0.5) for i, region in enumerate(regions)] + [("w0", "5S", 10, 1.0)]
    mart = spark.createDataFrame(rows, "wdid string, region string, enforcement_count long, total_outstanding double")
    parents = by_key(ops.region_rollup(mart), "region")
    assert set(parents) == {"5 - Central Valley", "6 - Lahontan", "", "XX", "1 - North Coast"}
    assert (parents["5 - Central Valley"]["facilities"], parents["5 - Central Valley"]["actions"]) == (3, 16)
    assert parents["5 - Central Valley"]["outstanding"] == 2.5
    offices = ops.suboffice_rollup(mart).collect()
    assert len(offices) == 8 and [r["actions"] for r in offices] == sorted((r["actions"] for r in offices), reverse=True)
    shown = ops.region_display(ops.suboffice_rollup(mart))
    assert shown.columns == ["Region", "Facilities", "Total actions", "Outstanding balance"]
    assert shown.first()["Region"] == offices[0]["region"]
    assert len(OFFICE_LABELS) == len(PARENT_LABELS) == 12 and len(set(PARENT_LABELS.values())) == 9


def test_key_match_profile(registry, actions):
    log = actions([action(k) for k in ("a", " A ", "b", "", None)])
    row = ops.key_match_profile(registry([{"wdid": "A"}, {"wdid": " a"}, {"wdid": " "}]), log).first()
    assert tuple(row) == (2, 3, 1, pytest.approx(2 / 3))
    with pytest.raises(ValueError):
        ops.key_match_profile(registry([]), log, action_key="wdid")


def test_empty_inputs(registry, actions):
    registered, log = registry([]), actions([])
    assert tuple(ops.key_match_profile(registered, log).first()) == (0, 0, 0, 0.0)
    staged = ops.stage_registry(registered), ops.stage_actions(log)
    facilities, fact = ops.dim_facility(*staged), ops.fact_actions(staged[1])
    assert ops.priority_facilities(fact, facilities).count() == 0
    mart = ops.mart_facility_monthly(fact, facilities)
    assert mart.count() == 0 and ops.kpi_totals(mart).first()["total_facilities"] == 0
    checks = {r["check"]: r["result"] for r in ops.quality_report(log, *staged, fact, facilities).collect()}
    assert len(checks) == 11 and set(checks.values()) == {0}


def test_reports_keep_rank_order(registry, actions):
    staged = ops.stage_actions(actions([action(f"k{i}", assessed=str(i * 1000)) for i in range(5)]))
    ranked = ops.priority_facilities(
        ops.fact_actions(staged), ops.dim_facility(ops.stage_registry(registry([])), staged)
    )
    shown = ops.priority_display(ranked).collect()
    assert [r["Rank"] for r in shown] == [1, 2, 3, 4, 5]
    assert shown[0]["Assessed"] == "$4,000" and shown[0]["Most recent"] == "2019-01-01"
    bars = [r["outstanding_balance"] for r in ops.priority_bar_order(ranked).collect()]
    assert bars == sorted(bars)


def test_duplicate_ids(spark):
    fact = spark.createDataFrame([("E1",), ("E1",), ("E2",), (None,), (None,)], "enforcement_eid string")
    assert [tuple(r) for r in ops.duplicate_ids(fact).collect()] == [("E1", 2)]


def test_match_report_goes_on_without_a_key_column(registry, actions):
    lines = [r["text"] for r in ops.match_report(registry([]), actions([action("a")])).orderBy("line").collect()]
    assert "Registry columns" in lines and "  WDID" in lines and lines[-1] == "Unmatched: 1"
    lines = [r["text"] for r in ops.match_report(registry([]).drop("wdid"), actions([action("a")])).orderBy("line").collect()]
    assert lines[-1].startswith("Key column not found: wdid")
