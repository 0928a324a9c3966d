from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from docketrank import operators as ops, sources
from docketrank.plans.refresh import FACT, MART, RANKED, RAW_ACTIONS, STAGED_ACTIONS, STAGED_REGISTRY, Refresh
from docketrank.sources.schemas import ACTION_COLUMNS, REGISTRY_COLUMNS


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def rows_with_null(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(v or "" for v in r))


def test_text_csv_keeps_text_and_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,note", '1,"a ""b"" c",', '2,"x, y","NA"', '3,"",007')
    df = sources.read_text_csv(spark, path, ("id", "name", "note"))
    assert rows(df) == [("1", 'a "b" c', None), ("2", "x, y", "NA"), ("3", None, "007")]
    assert sources.describe(df) == [("id", "string"), ("name", "string"), ("note", "string")]


def test_line_breaks_are_read_whole_only_where_they_are(spark, tmp_path):
    write(tmp_path / "plain file.csv", "id,note", "1,a", '2,"b"')
    write(tmp_path / "broken.csv", "id,note", '3,"line one', 'line two"', "4,d")
    found = {name.rsplit("/", 1)[1]: cut for name, cut in sources.line_breaks_by_file(spark, str(tmp_path)).items()}
    assert found == {"plain file.csv": False, "broken.csv": True}
    expected = [("1", "a"), ("2", "b"), ("3", "line one\nline two"), ("4", "d")]
    assert rows(sources.read_text_csv(spark, str(tmp_path))) == expected
    assert rows(sources.read_text_csv(spark, str(tmp_path), multi_line=True)) == expected


@pytest.mark.parametrize("seed", range(3))
def test_stray_quotes_lose_no_row(spark, tmp_path, seed):
    """Inch marks and quotes in unquoted fields beside line breaks in quoted ones, over small splits."""
    rng = random.Random(seed)
    notes = ['"a\nb"', '"q ""x"",\n""y"""', "plain", '"one, two"', "", 'pipe 5" wide', '12" outfall', 'say "hi"', '""']
    for name, some in (("one.csv", notes), ("two.csv", notes[2:5]), ("three.csv", notes[5:6])):
        lines = [f"{name}{i},{rng.choice(some)},{rng.choice(['', 7])}" for i in range(120)]
        write(tmp_path / name, "id,note,n", *lines, f'{name}last,stray " here,1')
    whole = rows_with_null(sources.read_text_csv(spark, str(tmp_path), multi_line=True))
    assert len(whole) == 363
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert rows_with_null(sources.read_text_csv(spark, str(tmp_path))) == whole
        kept, rejects = sources.read_text_csv_tolerant(spark, str(tmp_path))
        assert rows_with_null(kept) == whole and rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


NOTES_WITH_STRAY_QUOTES = ['"12 outfall', '"a"" b', '12 outfall"', '"12" outfall', 'say "hi"', '5" wide', "plain", '"quoted"', '"q, ""x"""', ""]


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_a_quote_that_opens_a_field_swallows_no_row(spark, tmp_path, multi_line):
    lines = [f"{i},x{i},y{i}" for i in range(1000)]
    lines[3] = '3,"12 outfall,y3'
    path = write(tmp_path / "a.csv", "id,a,b", *lines)
    rows = sources.read_text_csv_flagged(spark, path, multi_line=multi_line)
    assert rows.count() == 1000 and rows.where("rejected OR cut").count() == 0
    assert rows.where("id = 3").select("a", "b").first() == ('"12 outfall', "y3")


@pytest.mark.parametrize("seed", range(2))
def test_stray_quotes_anywhere_in_a_field(spark, tmp_path, seed):
    """At the start, inside and at the end of fields: every line is a row, whatever the setting."""
    rng = random.Random(seed)
    lines = [f"r{i},{rng.choice(NOTES_WITH_STRAY_QUOTES)},n{i},{rng.choice(NOTES_WITH_STRAY_QUOTES)}" for i in range(150)]
    path = write(tmp_path / "a.csv", "id,a,n,b", *lines)
    found = [sources.read_text_csv_flagged(spark, path, multi_line=m) for m in (None, True, False)]
    for rows in found:
        assert sorted(r["id"] for r in rows.collect()) == sorted(f"r{i}" for i in range(150))
    sound = [{r["id"]: r["n"] for r in rows.where("NOT rejected AND NOT cut").collect()} for rows in found]
    assert all(n == f"n{i[1:]}" for values in sound for i, n in values.items() if n and n.startswith("n"))
    assert sound[0] == sound[1]


def test_line_breaks_in_well_formed_fields_stay(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,a,b", '1,"two', 'lines",z', '2,"""Stop"", he', 'said",""', '3,"6 in,q', '4,k,"l1', 'l2"', "5,p,q")
    kept, rejects = sources.read_text_csv_tolerant(spark, path)
    got = {r["id"]: tuple(r)[1:] for r in kept.collect()}
    assert got["1"] == ("two\nlines", "z") and got["2"] == ('"Stop", he\nsaid', None)
    assert got["3"] == ('"6 in', "q") and got["5"] == ("p", "q")
    # What follows a stray quote up to the next one is read line by line; no text is lost.
    assert kept.count() + rejects.count() == 6


def test_strict_reader_fails_where_a_quote_swallows_rows(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,a,b", "1,x,y", '3,"12 outfall,y3', '4,"ok",z', "5,p,q")
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_text_csv(spark, path).collect()


def test_every_header_is_checked(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b,c", "1,2,3")
    write(tmp_path / "b.csv", "c,b,a", '1,"x', 'y",3')
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_text_csv(spark, str(tmp_path)).collect()


def test_cut_rows_are_flagged(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,a", "1,x", "2,x,more", "3")
    found = {r["id"]: (r["rejected"], r["cut"]) for r in sources.read_text_csv_flagged(spark, path).collect()}
    assert found == {"1": (False, False), "2": (False, True), "3": (True, False)}


def test_a_failed_write_leaves_the_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    sources.replace_parquet(spark.range(5), path)
    bad = spark.range(9).selectExpr("CASE WHEN id < 8 THEN id ELSE raise_error('broken') END AS id")
    with pytest.raises(Exception, match="broken"):
        sources.replace_parquet(bad, path)
    assert sources.read_parquet_layer(spark, path).count() == 5
    sources.replace_parquet(spark.range(7), path)
    assert sources.read_parquet_layer(spark, path).count() == 7


def test_a_layer_is_readable_whenever_its_writer_dies(spark, tmp_path):
    """After each step of a replacement the old rows or the new ones are there."""
    path = str(tmp_path / "layer")
    with pytest.raises(LookupError):
        sources.read_parquet_layer(spark, path)
    sources.replace_parquet(spark.range(5), path)
    old = sources.read_parquet_layer(spark, path)
    version = sources.write_version(spark.range(7), path)
    assert sources.read_parquet_layer(spark, path).count() == 5  # died before the marker
    assert sources.write_version(spark.range(8), path) == version + 1  # another writer takes another number
    sources.commit_version(spark, path, version)
    with pytest.raises(Exception, match="(?i)exist"):
        sources.commit_version(spark, path, version)
    assert sources.read_parquet_layer(spark, path).count() == 7 and old.count() == 5
    sources.replace_parquet(spark.range(9), path)
    sources.replace_parquet(spark.range(10), path)
    assert sources.read_parquet_layer(spark, path).count() == 10
    assert len([x for x in (tmp_path / "layer").iterdir() if x.name.startswith("v")]) == 2


def test_a_table_is_readable_whenever_its_writer_dies(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS docketrank_versions")
    name = "docketrank_versions.layer"
    sources.replace_table(spark.range(5), name)
    version = sources.write_table_version(spark.range(7).withColumnRenamed("id", "other"), name)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 5
    sources.commit_table_version(spark, name, version)
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 7
    for n in (8, 9, 10):
        sources.replace_table(spark.range(n), name)
    assert spark.table(name).count() == 10
    assert spark.sql("SHOW TABLES IN docketrank_versions").count() == 3  # the name, its version and the one before
    spark.sql("DROP DATABASE docketrank_versions CASCADE")


def test_footers_answer_without_reading_a_column(spark, tmp_path, plan):
    rows = spark.range(1000).selectExpr("id", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS day", "id % 3 AS part")
    rows.repartition(4).write.partitionBy("part").parquet(str(tmp_path / "rows"))
    figures = sources.footer_figures(spark, str(tmp_path / "rows"), F.count("*").alias("n"), F.max("day").alias("last"), where=F.col("part") == 1)
    assert "PushedAggregation: [COUNT(*), MAX(day)]" in plan(figures)
    assert tuple(figures.first()) == (333, date(2022, 9, 24))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_strict_reader_fails_on_a_bad_row_and_a_wrong_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name", "1,a", "2")
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_text_csv(spark, path).collect()
    with pytest.raises(ValueError, match="header"):
        sources.read_text_csv(spark, path, ("id", "title"))


@pytest.mark.parametrize("multi_line", [None, True])
def test_tolerant_reader_rejects_short_rows_and_cuts_long_ones(spark, tmp_path, multi_line):
    path = write(tmp_path / "a.csv", "id,a,b", "1,x,y", "2,x", "3,x,y,z", '4,"p,q"', '5,"p,q",', '6,"l1', 'l2",y')
    kept, rejects = sources.read_text_csv_tolerant(spark, path, multi_line=multi_line)
    assert rows(kept) == [("1", "x", "y"), ("3", "x", "y"), ("5", "p,q", None), ("6", "l1\nl2", "y")]
    assert rows(rejects) == [("2,x", "2"), ('4,"p,q"', "4")]
    assert kept.columns == ["id", "a", "b"] and kept.count() == 4 and rejects.count() == 2


def test_missing_and_empty_extracts(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_text_csv(spark, str(tmp_path / "none.csv"))
    empty = sources.read_text_csv(spark, write(tmp_path / "a.csv", "id,name"))
    with pytest.raises(sources.MissingExtract):
        sources.require_rows(empty, "registry")


def test_catalog(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert sources.table_exists(spark, "three_rows") and not sources.table_exists(spark, "no_such_table")
    assert sources.row_count(sources.require_table(spark, "three_rows")) == 3
    with pytest.raises(LookupError):
        sources.require_table(spark, "no_such_table")


def test_csv_export_writes_plain_numbers_and_tells_null_from_blank(spark, tmp_path):
    values = [(1, 12345678.9, ""), (2, 0.5, None), (3, -2e8, 'q"'), (4, 12345678.12345678, "x"), (5, 1.5e20, "x")]
    df = spark.createDataFrame(values, "i int, v double, t string")
    sources.export_csv(df.orderBy("i"), str(tmp_path / "out"), single_file=True)
    [part] = (tmp_path / "out").glob("*.csv")
    assert part.read_text().splitlines() == ["i,v,t", '1,12345678.9,""', "2,0.5,", '3,-200000000.0,"q"""', "4,12345678.12345678,x", "5,150000000000000000000.0,x"]


def csv_line(columns, **values):
    cells = (values.get(name, "") for name in columns)
    return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in cells)


def header(columns):
    return csv_line(columns, **{c: c for c in columns})


@pytest.fixture
def extracts(tmp_path):
    registry = [csv_line(REGISTRY_COLUMNS, wdid=f"w{i}", facility_name=f"Site, {i}", facility_region="5S") for i in range(40)]
    actions = [
        csv_line(
            ACTION_COLUMNS,
            WDID=f" W{i % 45} ",
            **{
                "ENFORCEMENT ID (EID)": str(i),
                "EFFECTIVE DATE": f"{1 + i % 12}/1/{2010 + i % 9}",
                "TOTAL ASSESSMENT AMOUNT": f"${i},000.50",
                "DESCRIPTION": 'two\nlines, "quoted"' if i == 7 else "",
            },
        )
        for i in range(1, 200)
    ]
    return (
        write(tmp_path / "registry.csv", header(REGISTRY_COLUMNS), *registry),
        write(tmp_path / "actions.csv", header(ACTION_COLUMNS), *actions, "too,short"),
    )


def test_full_refresh(spark, tmp_path, extracts):
    refresh = Refresh(spark, str(tmp_path / "warehouse"), str(tmp_path / "exports"))
    counts = refresh.run(*extracts)
    assert counts["raw_permits_orders"] == 40 and counts["raw_enforcement_actions"] == 199
    assert counts["fact_enforcement"] == 199 and counts["dim_facility"] == 45 and counts["priority_facilities"] == 25
    assert [r["record"] for r in refresh.rejects().collect()] == ["too,short"]
    assert counts["raw_enforcement_actions, rejected"] == 1 and counts["raw_enforcement_actions, cut"] == 0
    for layer, expected in counts.items():
        assert "," in layer or refresh.read(layer).count() == expected
    fact = refresh.read(FACT)
    assert fact.where("enforcement_eid = '7'").first()["description"] == 'two\nlines, "quoted"'
    assert fact.agg({"total_assessment_amount": "sum"}).first()[0] == sum(range(1, 200)) * 1000 + 199 * 0.5

    mart = sources.read_mart(spark, refresh.path(MART))
    assert "year" not in mart.columns and dict(mart.dtypes)["month"] == "timestamp_ntz"
    ranks = [r["rank"] for r in sources.read_ranked(spark, refresh.path(RANKED)).collect()]
    assert ranks == list(range(1, 26))

    exports = tmp_path / "exports"
    [ranked] = (exports / "priority_facilities").glob("*.csv")
    lines = ranked.read_text().splitlines()
    assert lines[0].startswith("rank,wdid,facility_name") and [x.split(",")[0] for x in lines[1:4]] == ["1", "2", "3"]
    [report] = (exports / "join_report").glob("*.txt")
    # Numbers 40 to 44 are not registered; each of the five has four actions.
    assert report.read_text().splitlines()[-3:] == ["Action rows with a key: 199", "Matched: 179 (89.9%)", "Unmatched: 20"]
    [schema] = (exports / "raw_schema").glob("*.csv")
    assert len(schema.read_text().splitlines()) == 73
    assert refresh.row_counts() == {layer: n for layer, n in counts.items() if "," not in layer}
    assert refresh.latest_action() == fact.agg({"effective_date": "max"}).first()[0]
    again = refresh.run(*extracts)
    assert again == counts


def test_a_load_that_fails_its_checks_takes_no_place(spark, tmp_path, extracts):
    refresh = Refresh(spark, str(tmp_path / "warehouse"), str(tmp_path / "exports"))
    refresh.load(*extracts)
    refresh.model()
    lines = (tmp_path / "actions.csv").read_text().replace("too,short\n", "")
    bad = write(tmp_path / "bad.csv", lines + "\n".join(["too,short"] * 300))
    with pytest.raises(ops.RefusedLoad, match="rejected: 300 of 499") as refused:
        refresh.load(extracts[0], bad)
    assert refused.value.figures["rejected"] == 300 and refresh.read(RAW_ACTIONS).count() == 199
    # The same ids once more: the log lands, the fact is refused.
    twice = write(tmp_path / "twice.csv", lines + "\n".join(lines.splitlines()[1:]))
    refresh.load(extracts[0], twice)
    before = refresh.read(FACT).count()
    with pytest.raises(ops.RefusedLoad, match="duplicate_ids") as refused:
        refresh.model()
    layers = [refresh.read(x) for x in (RAW_ACTIONS, STAGED_REGISTRY, STAGED_ACTIONS)]
    fact = ops.fact_actions(layers[2])
    report = ops.quality_report(*layers, fact, ops.dim_facility(*layers[1:]))
    figures = {r["check"]: r["result"] for r in report.collect()}
    assert refused.value.figures["duplicate_ids"] == figures["duplicate_ids"] > 0
    assert refresh.read(FACT).count() == before
    Refresh(spark, refresh.warehouse, refresh.exports, {"duplicate_ids": 1.0}).model()
    assert refresh.read(FACT).count() > before


def test_a_failed_load_leaves_the_layers(spark, tmp_path, extracts):
    refresh = Refresh(spark, str(tmp_path / "warehouse"), str(tmp_path / "exports"))
    refresh.load(*extracts)
    bare = write(tmp_path / "bare.csv", header(ACTION_COLUMNS))
    with pytest.raises(sources.MissingExtract):
        refresh.load(extracts[0], bare)
    assert refresh.read(RAW_ACTIONS).count() == 199


def test_steps_read_what_was_written(spark, tmp_path, extracts):
    refresh = Refresh(spark, str(tmp_path / "warehouse"), str(tmp_path / "exports"))
    refresh.load(*extracts)
    refresh.model(two_digit_year="pivot")
    refresh.answer(top=5)
    assert refresh.read(RANKED).count() == 5
    assert "rejected" not in refresh.read(RAW_ACTIONS).columns


def test_tables_in_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS docketrank_tests")
    sources.replace_table(spark.range(2), "docketrank_tests.layer")
    sources.replace_table(spark.range(5), "docketrank_tests.layer")
    assert sources.row_count(sources.require_table(spark, "docketrank_tests.layer")) == 5
    spark.sql("DROP DATABASE docketrank_tests CASCADE")


def test_only_new_files_are_loaded(spark, tmp_path):
    from docketrank.plans.incremental import ActionLoads

    def log(name, keys, *more):
        lines = [
            csv_line(ACTION_COLUMNS, WDID=k, STATUS="Active", **{"EFFECTIVE DATE": f"{1 + i % 12}/3/2015", "TOTAL ASSESSMENT AMOUNT": f"${i}.10"})
            for i, k in enumerate(keys)
        ]
        write(tmp_path / "in" / name, header(ACTION_COLUMNS), *lines, *more)

    (tmp_path / "in").mkdir()
    log("one.csv", ["a", "b", "a"], "too,short")
    log("two.csv", ["c", "a"])
    loads = ActionLoads(spark, str(tmp_path / "warehouse"))
    assert loads.run(str(tmp_path / "in")) == 1 and loads.rows().count() == 5
    assert loads.run(str(tmp_path / "in")) == 0 and loads.rows().count() == 5
    log("three.csv", ["a", "d"], "short,too")
    assert loads.run(str(tmp_path / "in")) == 1 and loads.rows().count() == 7
    assert sorted(r["record"] for r in loads.rejects().collect()) == ["short,too", "too,short"]
    assert {r["load"]: r["n"] for r in loads.rows().groupBy("load").agg(F.count("*").alias("n")).collect()} == {0: 5, 1: 2}
    whole = ops.daily_totals(ops.fact_actions(ops.stage_actions(sources.read_text_csv_tolerant(spark, str(tmp_path / "in"), ACTION_COLUMNS)[0])))
    assert loads.totals().exceptAll(whole).count() == 0 and loads.totals().count() == whole.count() > 4
    # A load that is tried again takes its own place.
    loads._load(spark.createDataFrame([(str(tmp_path / "in" / "three.csv"),)], "path string"), 1)
    assert loads.rows().count() == 7 and loads.totals().exceptAll(whole).count() == 0
