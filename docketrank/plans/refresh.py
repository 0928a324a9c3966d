"""A full refresh: raw extracts to written layers, one function per step.

Each step reads what the step before wrote, so a lost executor costs at most one step's work and
every later scan gets column pruning, pushed filters and size statistics from parquet. Rows are
counted while they are written, not in a second pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from docketrank.functions import implausible, is_nonblank
from docketrank.operators import (
    LOAD_LIMITS,
    dim_action_type,
    dim_facility,
    duplicate_ids,
    fact_actions,
    mart_facility_monthly,
    match_report,
    priority_facilities,
    require_quality,
    schema_snapshot,
    stage_actions,
    stage_registry,
)
from docketrank.operators.facts import MONEY_COLUMNS
from docketrank.operators.staging import raw_column
from docketrank.sources import (
    commit_version,
    current_version,
    export_csv,
    export_match_report,
    export_ranked_csv,
    export_schema,
    footer_figures,
    read_text_csv,
    read_parquet_layer,
    read_text_csv_flagged,
    require_rows,
    write_version,
)
from docketrank.sources.csv import CORRUPT_COLUMN
from docketrank.sources.schemas import ACTION_COLUMNS, REGISTRY_COLUMNS

# Names of the written layers.
RAW_REGISTRY, RAW_ACTIONS = "raw_permits_orders", "raw_enforcement_actions"
STAGED_REGISTRY, STAGED_ACTIONS = "stg_permits", "stg_enforcement"
FACILITIES, ACTION_TYPES, FACT = "dim_facility", "dim_action_type", "fact_enforcement"
MART, RANKED = "mart_facility_monthly", "priority_facilities"
LAYERS = (RAW_REGISTRY, RAW_ACTIONS, STAGED_REGISTRY, STAGED_ACTIONS, FACILITIES, ACTION_TYPES, FACT, MART, RANKED)


@dataclass
class Refresh:
    """Layers below ``warehouse``, exports below ``exports``; both on shared storage.

    ``limits`` are the largest shares of rows that may fail a check: a load beyond them is refused and
    the layer keeps the rows it had.
    """

    spark: SparkSession
    warehouse: str
    exports: str
    limits: Mapping[str, float] = field(default_factory=lambda: dict(LOAD_LIMITS))
    rows: dict[str, int] = field(default_factory=dict)

    def path(self, layer: str) -> str:
        return f"{self.warehouse}/{layer}"

    def read(self, layer: str) -> DataFrame:
        """A written layer; of the landed action log only the rows that were not rejected."""
        rows = read_parquet_layer(self.spark, self.path(layer))
        if layer == RAW_ACTIONS:
            return rows.where(F.col("rejected") == "false").drop(CORRUPT_COLUMN, "rejected", "cut")
        return rows

    def rejects(self) -> DataFrame:
        """Rows of the action log with too few fields, as raw records."""
        landed = read_parquet_layer(self.spark, self.path(RAW_ACTIONS))
        return landed.where(F.col("rejected") == "true").select(F.col(CORRUPT_COLUMN).alias("record"))

    def cut_rows(self) -> DataFrame:
        """Kept rows of the action log that had too many fields, as raw records."""
        landed = read_parquet_layer(self.spark, self.path(RAW_ACTIONS))
        return landed.where((F.col("rejected") == "false") & F.col("cut")).select(F.col(CORRUPT_COLUMN).alias("record"))

    def _write(
        self, layer: str, df: DataFrame, partition_by: Sequence[str] = (), checks: Mapping[str, Column] | None = None,
        unique: str | None = None,
    ) -> None:
        """Write a layer's next version, look at its figures, then switch to it.

        Rows, and rows that fail ``checks``, are counted while they are written; rows that share a value of
        ``unique`` with another are looked for in the version as written.
        """
        observed = Observation(f"rows of {layer}")
        failing = {name: F.count_if(F.coalesce(fails, F.lit(False))).alias(name) for name, fails in (checks or {}).items()}
        counted = df.observe(observed, F.count(F.lit(1)).alias("rows"), *failing.values())
        version = write_version(counted, self.path(layer), partition_by)
        figures = {name: count or 0 for name, count in observed.get.items()}
        rows = figures.pop("rows")
        if unique:
            written = self.spark.read.parquet(f"{self.path(layer)}/v{version:06d}")
            figures["duplicate_ids"] = duplicate_ids(written, unique).count()
        require_quality(layer, figures, rows, self.limits)
        commit_version(self.spark, self.path(layer), version)
        self.rows[layer] = rows - figures.get("rejected", 0)

    def row_counts(self) -> dict[str, int]:
        """Rows of every written layer, from the files' footers; no column is read."""
        counts = {}
        for layer in LAYERS:
            kept = F.col("rejected") == "false" if layer == RAW_ACTIONS else None
            path = current_version(self.spark, self.path(layer))
            figures = footer_figures(self.spark, path, F.count("*").alias("rows"), where=kept).first()
            # Files without row groups have no count to add up.
            counts[layer] = figures["rows"] or 0
        return counts

    def latest_action(self) -> date | None:
        """The latest day of the fact, from the files' footers."""
        path = current_version(self.spark, self.path(FACT))
        return footer_figures(self.spark, path, F.max("effective_date").alias("day")).first()["day"]

    def load(self, registry_csv: str, actions_csv: str, multi_line: bool | None = None) -> None:
        """Land both CSV extracts as text columns, each parsed once.

        Rejected rows of the action log go to a partition of their own, which later steps skip
        by partition pruning. Both extracts have to have a usable row before any layer is touched.
        Rows that were cut or rejected are counted beside the layers' rows.
        """
        registry = read_text_csv(self.spark, registry_csv, REGISTRY_COLUMNS, multi_line)
        actions = read_text_csv_flagged(self.spark, actions_csv, ACTION_COLUMNS, multi_line)
        require_rows(registry, RAW_REGISTRY)
        require_rows(actions.where(~F.col("rejected")), RAW_ACTIONS)
        self._write(RAW_REGISTRY, registry)
        blank_key = ~F.col("rejected") & ~F.coalesce(is_nonblank(raw_column("WDID")), F.lit(False))
        self._write(RAW_ACTIONS, actions, ["rejected"], {"rejected": F.col("rejected"), "key_missing": blank_key})
        for name, rows in (("rejected", self.rejects()), ("cut", self.cut_rows())):
            self.rows[f"{RAW_ACTIONS}, {name}"] = rows.count()
        tables = {layer: self.read(layer) for layer in (RAW_REGISTRY, RAW_ACTIONS)}
        export_schema(schema_snapshot(self.spark, tables), f"{self.exports}/raw_schema")

    def profile(self) -> None:
        report = match_report(self.read(RAW_REGISTRY), self.read(RAW_ACTIONS))
        export_match_report(report, f"{self.exports}/join_report")

    def model(self, two_digit_year: str = "literal") -> None:
        self._write(STAGED_REGISTRY, stage_registry(self.read(RAW_REGISTRY)))
        self._write(STAGED_ACTIONS, stage_actions(self.read(RAW_ACTIONS), two_digit_year))
        registry, actions = self.read(STAGED_REGISTRY), self.read(STAGED_ACTIONS)
        self._write(FACILITIES, dim_facility(registry, actions))
        self._write(ACTION_TYPES, dim_action_type(actions))
        amounts = reduce(Column.__or__, (implausible(F.col(name)) for name in MONEY_COLUMNS))
        self._write(FACT, fact_actions(actions), checks={"implausible_amounts": amounts}, unique="enforcement_eid")

    def mart(self) -> None:
        self._write(MART, mart_facility_monthly(self.read(FACT), self.read(FACILITIES)), ["year"])
        export_csv(self.read(MART), f"{self.exports}/{MART}")

    def answer(self, top: int = 25) -> None:
        self._write(RANKED, priority_facilities(self.read(FACT), self.read(FACILITIES), top, self.latest_action()))
        export_ranked_csv(self.read(RANKED), f"{self.exports}/{RANKED}")

    def run(
        self,
        registry_csv: str,
        actions_csv: str,
        top: int = 25,
        two_digit_year: str = "literal",
        multi_line: bool | None = None,
    ) -> dict[str, int]:
        """All steps in order; returns the rows of every layer."""
        self.load(registry_csv, actions_csv, multi_line)
        self.profile()
        self.model(two_digit_year)
        self.mart()
        self.answer(top)
        return self.rows
