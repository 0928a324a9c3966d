"""Figures that parquet files state in their footers: counts and extremes without reading a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

# The newer parquet source answers count, min and max from footers when it may.
_FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_figures(spark: SparkSession, path: str, *figures: Column, where: Column | None = None) -> DataFrame:
    """One row of counts, minima and maxima over a parquet folder, taken from the files' footers.

    ``figures`` are aggregates of columns that footers know: counts of rows, extremes of numbers and dates.
    ``where`` may only use the folder's partition columns. Settings stay those of the session: the
    query belongs to a session beside it, which shares its context.
    """
    beside = spark.newSession()
    for key, value in _FOOTER_SETTINGS.items():
        beside.conf.set(key, value)
    rows = beside.read.parquet(path)
    return (rows if where is None else rows.where(where)).agg(*figures)
