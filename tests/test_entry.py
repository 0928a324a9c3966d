"""Every catalogued query against its SQL twin, at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_points
from docketrank.plans.catalogue import CATALOGUE

SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def sql(tables):
    connection = duckdb.connect()
    for name in ("orders", "customer", "supplier", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_a_twin():
    assert set(CATALOGUE) <= set(entry_points.oracle_sql()) and set(CATALOGUE) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query_equals_sql(spark, sql, tables, name):
    df = entry_points.queries()[name](spark, tables)
    result = sql.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {column: SQL_TYPES[kind] for column, kind in df.dtypes} == types
    got = [tuple(row) for row in df.select(*(f"`{c}`" for c in columns)).collect()]
    assert in_order(got) == in_order(result.fetchall())


def test_flagship(spark):
    ranked = entry_points.entry(spark)
    assert ranked.count() == 25 and ranked.columns[0] == "rank"


def test_layers_agree_with_each_other(spark, tables):
    """Sums over the mart are sums over the dated facts; regions add up to the headline figures."""
    from docketrank import operators as ops
    from docketrank.functions import exact_total
    from docketrank.plans.layers import Layers

    layers = Layers.from_tables(spark, tables)
    mart, fact, facilities = layers.mart.cache(), layers.fact.cache(), layers.facilities.cache()
    headline = ops.kpi_totals(mart).first()
    dated = fact.where("effective_date IS NOT NULL")
    assert headline["total_actions"] == dated.count()
    assert headline["total_outstanding"] == dated.agg(exact_total(dated.outstanding_amount).alias("s")).first()["s"]
    regional = ops.region_rollup(mart).agg({"actions": "sum"}).first()[0]
    outside = mart.where("region IS NULL OR region = 'NA'").agg({"enforcement_count": "sum"}).first()[0]
    assert regional + outside == headline["total_actions"]
    assert facilities.count() == facilities.select("wdid").distinct().count()
    assert fact.join(facilities, "wdid").count() == fact.join(facilities, "wdid", "left").count() == fact.count()
    for cached in (mart, fact, facilities):
        cached.unpersist()


def test_a_session_without_arguments_starts_with_many_partitions(monkeypatch):
    from docketrank import session

    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def config(self, key, value):
            seen[key] = value
            return self

        def getOrCreate(self):
            return None

    class Fake:
        builder = Builder()

    monkeypatch.setattr(session, "SparkSession", Fake)
    session.build_session()
    assert int(seen["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 1000
