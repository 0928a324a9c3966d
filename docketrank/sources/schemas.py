"""Raw column names and the staging contract of the two extracts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# The header of the permit registry extract, all text.
REGISTRY_COLUMNS = (
    "reg_measure_id",
    "reg_measure_type",
    "order_number",
    "npdes_number_ca_number",
    "program_category",
    "wdid",
    "major_minor",
    "status",
    "effective_date",
    "expiration_review_date",
    "termination_date",
    "adoption_date",
    "wdr_review_amend",
    "wdr_review_revise_renew",
    "wdr_review_rescind",
    "wdr_review_no_action_required",
    "wdr_review_pending",
    "wdr_review_planned",
    "status_enrollee",
    "individual_general",
    "fee_code",
    "design_flow",
    "threat_to_water_quality",
    "complexity",
    "pretreatment",
    "population_ms4_acres",
    "reclamation",
    "facility_waste_type",
    "facility_waste_type_2",
    "number_of_amendments",
    "facility_id",
    "facility_region",
    "facility_name",
    "place_type",
    "place_address",
    "place_city",
    "place_zip",
    "place_county",
    "latitude_decimal_degrees",
    "longitude_decimal_degrees",
)

# The header of the enforcement action extract, all text.
ACTION_COLUMNS = (
    "REGION",
    "FACILITY ID",
    "FACILITY NAME",
    "AGENCY NAME",
    "PLACE TYPE",
    "PLACE SUBTYPE",
    "PLACE LATITUDE",
    "PLACE LONGITUDE",
    "WDID",
    "REG MEASURE ID",
    "REG MEASURE TYPE",
    "ENFORCEMENT ID (EID)",
    "ORDER / RESOLUTION NUMBER",
    "ENFORCEMENT ACTION TYPE",
    "EFFECTIVE DATE",
    "ADOPTION / ISSUANCE DATE",
    "TERMINATION DATE",
    "ACL ISSUANCE DATE",
    "EPL ISSUANCE DATE",
    "STATUS",
    "TITLE",
    "DESCRIPTION",
    "PROGRAM",
    "PROGRAM CATEGORY",
    "TOTAL ASSESSMENT AMOUNT",
    "INITIAL ASSESSED AMOUNT",
    "LIABILITY $ AMOUNT",
    "PROJECT $ AMOUNT",
    "LIABILITY $ PAID",
    "PROJECT $ COMPLETED",
    "TOTAL $ PAID/COMPLETED AMOUNT",
    "Location 1",
)


class Staged(NamedTuple):
    """One staged column: its name, the raw column it comes from and how it is read."""

    name: str
    raw: str
    kind: str = "text"  # key, text, number, money, date


# Staged names of the registry columns and how each is read.
REGISTRY_STAGING = (
    Staged("wdid", "wdid", "key"),
    Staged("reg_measure_id", "reg_measure_id"),
    Staged("reg_measure_type", "reg_measure_type"),
    Staged("program_category", "program_category"),
    Staged("facility_id", "facility_id"),
    Staged("facility_region", "facility_region"),
    Staged("facility_name", "facility_name"),
    Staged("place_type", "place_type"),
    Staged("place_address", "place_address"),
    Staged("place_city", "place_city"),
    Staged("place_zip", "place_zip"),
    Staged("place_county", "place_county"),
    Staged("latitude", "latitude_decimal_degrees", "number"),
    Staged("longitude", "longitude_decimal_degrees", "number"),
    Staged("permit_status", "status"),
    Staged("effective_date", "effective_date", "date"),
    Staged("termination_date", "termination_date", "date"),
    Staged("adoption_date", "adoption_date", "date"),
)

# Staged names of the action columns and how each is read.
ACTION_STAGING = (
    Staged("wdid", "WDID", "key"),
    Staged("enforcement_eid", "ENFORCEMENT ID (EID)"),
    Staged("region", "REGION"),
    Staged("facility_id", "FACILITY ID"),
    Staged("facility_name", "FACILITY NAME"),
    Staged("agency_name", "AGENCY NAME"),
    Staged("place_type", "PLACE TYPE"),
    Staged("place_subtype", "PLACE SUBTYPE"),
    Staged("latitude", "PLACE LATITUDE", "number"),
    Staged("longitude", "PLACE LONGITUDE", "number"),
    Staged("reg_measure_id", "REG MEASURE ID"),
    Staged("reg_measure_type", "REG MEASURE TYPE"),
    Staged("order_resolution_number", "ORDER / RESOLUTION NUMBER"),
    Staged("enforcement_action_type", "ENFORCEMENT ACTION TYPE"),
    Staged("status", "STATUS"),
    Staged("program", "PROGRAM"),
    Staged("program_category", "PROGRAM CATEGORY"),
    Staged("title", "TITLE"),
    Staged("description", "DESCRIPTION"),
    Staged("effective_date", "EFFECTIVE DATE", "date"),
    Staged("adoption_date", "ADOPTION / ISSUANCE DATE", "date"),
    Staged("termination_date", "TERMINATION DATE", "date"),
    Staged("total_assessment_amount", "TOTAL ASSESSMENT AMOUNT", "money"),
    Staged("initial_assessed_amount", "INITIAL ASSESSED AMOUNT", "money"),
    Staged("liability_amount", "LIABILITY $ AMOUNT", "money"),
    Staged("project_amount", "PROJECT $ AMOUNT", "money"),
    Staged("liability_paid", "LIABILITY $ PAID", "money"),
    Staged("project_completed", "PROJECT $ COMPLETED", "money"),
    Staged("total_paid_completed", "TOTAL $ PAID/COMPLETED AMOUNT", "money"),
)

# Action types without legal weight; every other non-blank type is formal.
INFORMAL_ACTION_TYPES = (
    "Oral Communication",
    "Staff Enforcement Letter",
    "13267 Letter",
    "Notice to Comply",
    "Notice of Violation",
    "Notice of Stormwater Noncomp",
)

# Office labels of the region codes.
OFFICE_LABELS = {
    "1": "1 - North Coast",
    "2": "2 - San Francisco Bay",
    "3": "3 - Central Coast",
    "4": "4 - Los Angeles",
    "5S": "5S - Central Valley (Sacramento)",
    "5F": "5F - Central Valley (Fresno)",
    "5R": "5R - Central Valley (Redding)",
    "6A": "6A - Lahontan (South Lake Tahoe)",
    "6B": "6B - Lahontan (Victorville)",
    "7": "7 - Colorado River",
    "8": "8 - Santa Ana",
    "9": "9 - San Diego",
}

# The same codes with the sub-offices of regions 5 and 6 merged.
PARENT_LABELS = {
    "1": "1 - North Coast",
    "2": "2 - San Francisco Bay",
    "3": "3 - Central Coast",
    "4": "4 - Los Angeles",
    "5S": "5 - Central Valley",
    "5F": "5 - Central Valley",
    "5R": "5 - Central Valley",
    "6A": "6 - Lahontan",
    "6B": "6 - Lahontan",
    "7": "7 - Colorado River",
    "8": "8 - Santa Ana",
    "9": "9 - San Diego",
}

# Fixed value: the region text of registry entries that belong to no region.
NO_REGION = "NA"


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    """Every column text; raw extracts are never type-inferred."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
