"""Exact distinct counts that roll up: sets of facilities as bitmaps per month and region.

A distinct count can't be added up, a set can be united. With the sets kept per month and region, any
range of months and any grouping of regions is counted without a row per facility.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketrank.functions import map_label
from docketrank.operators.regions import most_actions_first
from docketrank.sources.schemas import NO_REGION

# Bits of one of Spark's bitmaps.
BITS = 32768


def facility_numbers(facilities: DataFrame, parts: int = 8) -> DataFrame:
    """``wdid`` and ``facility_no``: whole numbers from 1, the same in every run and nearly dense.

    Keys are dealt by hash into ``parts``, each numbered by itself in the order of its keys, so no task
    sees all of them; a part fills whole bitmaps one after the other. About one part for every 16,000
    facilities keeps bitmaps well filled.
    """
    part = F.pmod(F.xxhash64("wdid"), F.lit(parts))
    place = F.row_number().over(Window.partitionBy("part").orderBy("wdid")) - 1
    numbered = facilities.select("wdid", part.alias("part")).withColumn("place", place.cast("long"))
    bitmap = F.floor(F.col("place") / BITS) * parts + F.col("part")
    return numbered.select("wdid", (bitmap * BITS + F.col("place") % BITS + 1).alias("facility_no"))


def month_bitmaps(mart: DataFrame, numbers: DataFrame) -> DataFrame:
    """The mart per region, month and bitmap: which facilities, how many actions, how much money.

    Rows of one table can be united with those of another load of other months as they are.
    """
    number = F.col("facility_no")
    return (
        mart.select("wdid", "region", "month", "enforcement_count", "total_outstanding")
        .join(numbers, "wdid")
        .groupBy("region", "month", F.bitmap_bucket_number(number).alias("bitmap_no"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("facilities"),
            F.sum("enforcement_count").alias("actions"),
            F.sum(F.col("total_outstanding").cast("decimal(38,2)")).alias("outstanding"),
        )
    )


def _united(bitmaps: DataFrame, *keys: Column) -> DataFrame:
    """Facilities, actions and money by the keys; united per bitmap first, which is what moves."""
    names = [f"k{i}" for i in range(len(keys))]
    per_bitmap = bitmaps.groupBy(*(key.alias(name) for key, name in zip(keys, names, strict=True)), "bitmap_no").agg(
        F.bitmap_count(F.bitmap_or_agg("facilities")).alias("facilities"),
        F.sum("actions").alias("actions"),
        F.sum("outstanding").alias("outstanding"),
    )
    return per_bitmap.groupBy(*names).agg(
        F.sum("facilities").alias("facilities"),
        F.sum("actions").cast("long").alias("actions"),
        F.sum("outstanding").cast("double").alias("outstanding"),
    )


def rollup_from_bitmaps(bitmaps: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Facilities, actions and outstanding money per label of a region; rows without a region stay out."""
    in_region = bitmaps.where(F.col("region").isNotNull() & (F.col("region") != NO_REGION))
    united = _united(in_region, map_label(F.col("region"), labels))
    return most_actions_first(united.withColumnRenamed("k0", "region"))


def kpis_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One row of headline figures over all months that the bitmaps hold."""
    return _united(bitmaps).select(
        F.coalesce("facilities", F.lit(0).cast("long")).alias("total_facilities"),
        F.col("actions").alias("total_actions"),
        F.col("outstanding").alias("total_outstanding"),
    )
