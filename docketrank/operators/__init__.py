"""Frame-level operators: each takes DataFrames and returns a lazy DataFrame."""

from docketrank.operators.bitmaps import facility_numbers, kpis_from_bitmaps, month_bitmaps, rollup_from_bitmaps
from docketrank.operators.daily import (
    daily_totals,
    mart_from_daily,
    merge_totals,
    priority_from_daily,
    summary_from_daily,
    with_year,
)
from docketrank.operators.dimensions import (
    actions_representative,
    dim_action_type,
    dim_facility,
    is_formal_type,
    key_spine,
    registry_representative,
    representative,
)
from docketrank.operators.facts import action_formality, fact_actions
from docketrank.operators.joins import lookup_join, unique_lookup
from docketrank.operators.mart import kpi_totals, mart_facility_monthly, monthly_totals
from docketrank.operators.profile import key_match_profile, match_report
from docketrank.operators.quality import (
    LOAD_LIMITS,
    RefusedLoad,
    duplicate_ids,
    layer_row_counts,
    quality_report,
    require_quality,
    schema_snapshot,
)
from docketrank.operators.ranking import action_summary, facility_summary, priority_facilities, rank_facilities
from docketrank.operators.regions import (
    region_display,
    region_label,
    region_parent_label,
    region_rollup,
    rollup_by_label,
    suboffice_rollup,
)
from docketrank.operators.reports import in_rank_order, priority_bar_order, priority_display
from docketrank.operators.staging import stage, stage_actions, stage_registry

__all__ = [
    "LOAD_LIMITS",
    "RefusedLoad",
    "action_formality",
    "action_summary",
    "actions_representative",
    "daily_totals",
    "dim_action_type",
    "dim_facility",
    "duplicate_ids",
    "facility_numbers",
    "facility_summary",
    "fact_actions",
    "in_rank_order",
    "is_formal_type",
    "key_match_profile",
    "key_spine",
    "kpi_totals",
    "kpis_from_bitmaps",
    "layer_row_counts",
    "lookup_join",
    "mart_facility_monthly",
    "mart_from_daily",
    "match_report",
    "merge_totals",
    "month_bitmaps",
    "monthly_totals",
    "priority_bar_order",
    "priority_display",
    "priority_facilities",
    "priority_from_daily",
    "quality_report",
    "rank_facilities",
    "region_display",
    "region_label",
    "region_parent_label",
    "region_rollup",
    "registry_representative",
    "representative",
    "require_quality",
    "rollup_by_label",
    "rollup_from_bitmaps",
    "schema_snapshot",
    "stage",
    "stage_actions",
    "stage_registry",
    "suboffice_rollup",
    "summary_from_daily",
    "unique_lookup",
    "with_year",
]
