"""Tables as parquet folders or in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketrank.sources.sinks import read_parquet_layer


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) of a table."""
    return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]


def row_count(df: DataFrame) -> int:
    return df.count()


def require_table(spark: SparkSession, name: str) -> DataFrame:
    if not table_exists(spark, name):
        raise LookupError(f"table {name} not found; run the step that writes it first")
    return spark.table(name)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart as a dashboard reads it: without ``year``, the month as a timestamp."""
    return read_parquet_layer(spark, path).drop("year").withColumn("month", F.col("month").cast("timestamp_ntz"))


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet_layer(spark, path).orderBy(F.asc_nulls_last("rank"))
