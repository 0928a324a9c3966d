"""Data-quality figures over every layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketrank.functions import implausible, is_nonblank
from docketrank.operators.facts import MONEY_COLUMNS
from docketrank.operators.staging import raw_column
from docketrank.sources.schemas import NO_REGION


def duplicate_ids(fact: DataFrame, id_column: str = "enforcement_eid") -> DataFrame:
    """Identifiers carried by more than one row, with the number of rows."""
    return (
        fact.where(F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


# Largest shares of a load's rows that may fail a check before the load is refused.
LOAD_LIMITS = {"rejected": 0.2, "key_missing": 0.5, "duplicate_ids": 0.1, "implausible_amounts": 0.01}


class RefusedLoad(RuntimeError):
    """A load in which too many rows fail a check; ``figures`` has the counts by check."""

    def __init__(self, layer: str, figures: Mapping[str, int], rows: int, broken: Mapping[str, float]) -> None:
        listed = ", ".join(f"{name}: {figures[name]} of {rows} (limit {share:.0%})" for name, share in broken.items())
        super().__init__(f"{layer} keeps its old rows; the new ones fail {listed}")
        self.figures = dict(figures)


def require_quality(layer: str, figures: Mapping[str, int], rows: int, limits: Mapping[str, float]) -> None:
    """Refuse a load whose counts of failing rows pass their limits; checks without a limit pass."""
    broken = {name: limits[name] for name, count in figures.items() if name in limits and count > limits[name] * rows}
    if broken:
        raise RefusedLoad(layer, figures, rows, broken)


def _checks(one_row: DataFrame) -> DataFrame:
    """Turn a one-row frame of figures into rows of (check, result)."""
    return one_row.unpivot([], one_row.columns, "check", "result").select("check", F.col("result").cast("long"))


def quality_report(
    raw_actions: DataFrame, registry: DataFrame, actions: DataFrame, fact: DataFrame, facilities: DataFrame
) -> DataFrame:
    """The documented checks as rows of (check, result).

    The log is scanned four times: raw once; the fact once, grouped by identifier with the other
    figures added up beside it; the keys of both extracts once each, in one frame with flags that
    answers every question about keys. Everything combines before it is shuffled.
    """

    def tally(condition):
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))

    key_parts = raw_actions.agg(
        F.count("*").alias("action_rows"),
        tally(~F.coalesce(is_nonblank(raw_column("WDID")), F.lit(False))).alias("key_missing"),
    )
    assessed, paid = F.col("total_assessment_amount"), F.col("total_paid_completed")
    by_id = fact.groupBy("enforcement_eid").agg(
        F.count("*").alias("rows"),
        tally(assessed == 0).alias("zero_assessment"),
        tally(F.col("outstanding_amount") == 0).alias("zero_outstanding"),
        tally(assessed < paid).alias("negative_before_floor"),
        tally(reduce(Column.__or__, (implausible(F.col(name)) for name in MONEY_COLUMNS))).alias("implausible_amounts"),
    )
    fact_parts = by_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("fact_rows"),
        *(
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("zero_assessment", "zero_outstanding", "negative_before_floor", "implausible_amounts")
        ),
        tally(F.col("enforcement_eid").isNotNull() & (F.col("rows") > 1)).alias("duplicate_ids"),
    )
    flagged = registry.select("wdid", F.lit(1).alias("r"), F.lit(0).alias("a")).unionAll(
        actions.select("wdid", F.lit(0).alias("r"), F.lit(1).alias("a"))
    )
    keys = flagged.groupBy("wdid").agg(F.max("r").alias("registered"), F.max("a").alias("acted"))
    # Every facility is a key of an extract, so the facilities' join keeps all keys.
    facility_parts = (
        keys.join(facilities.select("wdid", "region"), "wdid", "left")
        .groupBy("region")
        .agg(tally(F.col("acted") == 0).alias("idle"), tally(F.col("registered") == 0).alias("unregistered"))
        .agg(
            tally(F.col("region") != NO_REGION).alias("region_codes"),
            F.coalesce(F.sum(F.when(F.col("region") == NO_REGION, F.col("idle"))), F.lit(0)).alias(
                "registry_only_without_region"
            ),
            F.coalesce(F.sum("unregistered"), F.lit(0)).alias("facilities_without_registry_row"),
        )
    )
    return reduce(DataFrame.unionByName, (_checks(part) for part in (key_parts, fact_parts, facility_parts)))


def layer_row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every layer as (layer, rows)."""
    counts = (
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows") for name, df in layers.items()
    )
    return reduce(DataFrame.unionByName, counts)


def schema_snapshot(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of every table as (table, position, column, type); metadata only, nothing is read."""
    rows = [
        (table, position, field.name, field.dataType.simpleString())
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")
