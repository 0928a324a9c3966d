"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query is built and
run ``BENCH_RUNS`` times into a sink that discards rows; the best run counts, building included.

``queries`` derive the text extracts from the tables each time. ``derivation`` is the time to derive
and land them once, and ``engine`` that of the same queries over the landed text.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from docketrank.plans.catalogue import BUILDS, CATALOGUE
from docketrank.plans.layers import Layers
from docketrank.session import build_session

HEADLINE = (
    "stage_registry",
    "stage_actions",
    "dim_facility",
    "dim_action_type",
    "fact_actions",
    "fact_actions_by_lookup",
    "mart_monthly",
    "facility_summary",
    "priority",
    "kpi_totals",
    "region_rollup",
    "suboffice_rollup",
    "key_match_profile",
    "layer_row_counts",
    "quality_report",
    "duplicate_ids",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("docketrank-bench", f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def timed(build) -> float:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        return round(best, 3)

    seconds = {name: timed(lambda name=name: CATALOGUE[name](spark, folder)) for name in HEADLINE}
    with tempfile.TemporaryDirectory(prefix="docketrank-bench-") as landed:
        start = time.perf_counter()
        layers = Layers.from_tables(spark, folder)
        layers.raw_registry.write.parquet(f"{landed}/registry")
        layers.raw_actions.write.parquet(f"{landed}/actions")
        derivation = round(time.perf_counter() - start, 3)
        raw = [spark.read.parquet(f"{landed}/{name}") for name in ("registry", "actions")]
        engine = {name: timed(lambda name=name: BUILDS[name](Layers(*raw))) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "derivation": derivation,
                "engine": engine,
                "engine_total": round(sum(engine.values()), 3),
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
