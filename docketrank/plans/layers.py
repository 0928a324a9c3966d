"""The layers from raw text to ranked list, wired together lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from docketrank.operators import (
    dim_action_type,
    dim_facility,
    fact_actions,
    mart_facility_monthly,
    priority_facilities,
    stage_actions,
    stage_registry,
)
from docketrank.plans import extracts


class Layers:
    """Every layer over a pair of raw extracts, each a plan that is built when first asked for.

    Nothing is computed or held here; Catalyst prunes what a query on a layer does not use.
    """

    def __init__(self, raw_registry: DataFrame, raw_actions: DataFrame):
        self.raw_registry = raw_registry
        self.raw_actions = raw_actions

    @classmethod
    def from_tables(cls, spark: SparkSession, folder: str) -> Layers:
        return _TableLayers(spark, folder)

    @cached_property
    def registry(self) -> DataFrame:
        return stage_registry(self.raw_registry)

    @cached_property
    def actions(self) -> DataFrame:
        return stage_actions(self.raw_actions)

    @cached_property
    def facilities(self) -> DataFrame:
        return dim_facility(self.registry, self.actions)

    @cached_property
    def action_types(self) -> DataFrame:
        return dim_action_type(self.actions)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_actions(self.actions)

    @cached_property
    def mart(self) -> DataFrame:
        return mart_facility_monthly(self.fact, self.facilities)

    @cached_property
    def ranked(self) -> DataFrame:
        return priority_facilities(self.fact, self.facilities)


class _TableLayers(Layers):
    """Layers over extracts derived from order tables; an extract nobody asks for is not built."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    @cached_property
    def raw_registry(self) -> DataFrame:
        return extracts.raw_registry(self._spark, self._folder)

    @cached_property
    def raw_actions(self) -> DataFrame:
        return extracts.raw_actions(self._spark, self._folder)
