"""Loads of new files only: a stream that lists, lands and sums up what came since the last run.

The stream's checkpoint knows which files are done. Each run takes all new files as one or more loads
(``Trigger.AvailableNow``) and ends. A load has a number and partitions of its own in every layer it
writes, which it overwrites if it is tried again; so a run that dies half way counts nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketrank.operators import daily_totals, fact_actions, merge_totals, stage_actions
from docketrank.sources import read_text_csv_flagged
from docketrank.sources.csv import CORRUPT_COLUMN
from docketrank.sources.schemas import ACTION_COLUMNS

# Fixed by the binary file source, of which only ``path`` is read.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _overwrite_load(rows: DataFrame, path: str, *partition_by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


@dataclass
class ActionLoads:
    """The action log as it comes in, file by file, below ``warehouse``."""

    spark: SparkSession
    warehouse: str
    files_per_load: int = 1000

    @property
    def landed(self) -> str:
        return f"{self.warehouse}/landed_actions"

    @property
    def daily(self) -> str:
        return f"{self.warehouse}/daily_totals"

    def _load(self, files: DataFrame, number: int) -> None:
        paths = sorted(row["path"] for row in files.collect())  # file names, at most files_per_load
        if not paths:
            return
        rows = read_text_csv_flagged(self.spark, paths, ACTION_COLUMNS).withColumn("load", F.lit(number))
        # Rejected rows go to partitions of their own.
        _overwrite_load(rows, self.landed, "load", "rejected")
        kept = self.rows().where(F.col("load") == number).drop("load")
        totals = daily_totals(fact_actions(stage_actions(kept))).withColumn("load", F.lit(number))
        _overwrite_load(totals, self.daily, "load")

    def run(self, source: str) -> int:
        """Land what is new in folder ``source``; returns how many loads that took."""
        files = (
            self.spark.readStream.format("binaryFile")
            .schema(_FILE_SCHEMA)
            .option("maxFilesPerTrigger", self.files_per_load)
            .load(source)
            .select("path")
        )
        loads = []

        def load(batch: DataFrame, number: int) -> None:
            self._load(batch, number)
            loads.append(number)

        stream = files.writeStream.foreachBatch(load).option("checkpointLocation", f"{self.warehouse}/seen_files")
        stream.trigger(availableNow=True).start().awaitTermination()
        return len(loads)

    def rows(self) -> DataFrame:
        """All landed rows that were not rejected, as text, with the number of their load."""
        rows = self.spark.read.parquet(self.landed).where(F.col("rejected") == "false")
        return rows.drop(CORRUPT_COLUMN, "rejected", "cut")

    def rejects(self) -> DataFrame:
        """Rejected rows as raw records, with the number of their load."""
        rows = self.spark.read.parquet(self.landed).where(F.col("rejected") == "true")
        return rows.select("load", F.col(CORRUPT_COLUMN).alias("record"))

    def totals(self) -> DataFrame:
        """Totals per facility and day over all loads; mart and ranking are made from these."""
        return merge_totals(self.spark.read.parquet(self.daily))
