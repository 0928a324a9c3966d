"""The catalogue once more as ANSI SQL over the typed tables.

The Spark side writes messy text and reads it back; these statements never see text, they state
the typed value each row must come back with. The two sides share no cleaning logic.
"""

from __future__ import annotations

from docketrank.sources.schemas import ACTION_COLUMNS, REGISTRY_COLUMNS

# Fixed values, written out once more so that a wrong label on the other side shows.
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
PARENT_LABELS = {
    **OFFICE_LABELS,
    "5S": "5 - Central Valley",
    "5F": "5 - Central Valley",
    "5R": "5 - Central Valley",
    "6A": "6 - Lahontan",
    "6B": "6 - Lahontan",
}

_REGION_LIST = "['1','2','3','4','5S','5F','5R','6A','6B','7','8','9','NA']"

# Typed money per order.
_PAYMENTS = """
payments AS (
  SELECT l_orderkey AS k,
         CAST(SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN cents END) AS DOUBLE) AS total_paid,
         CAST(SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN cents END) AS DOUBLE) AS liability,
         CAST(SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN cents END) AS DOUBLE) AS liability_paid,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN cents END) AS DOUBLE) AS project,
         CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN cents END) AS DOUBLE) AS project_done
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS cents FROM lineitem) priced
  GROUP BY l_orderkey
)"""

# Every order with the staged values it must come back with; wdid is NULL where the key is blank.
_ORDERED = f"""
ordered AS (
  SELECT o.o_orderkey AS k, 'ORD-' || o.o_orderkey AS order_number, o.o_totalprice AS price,
         CASE WHEN o.o_orderkey % 89 = 0 OR o.o_orderkey % 97 = 0 THEN NULL
              ELSE 'WD' || lpad(CAST(o.o_custkey AS VARCHAR), 8, '0') END AS wdid,
         'E' || CASE WHEN o.o_orderkey % 211 = 0 THEN o.o_orderkey + 1 ELSE o.o_orderkey END AS enforcement_eid,
         {_REGION_LIST}[CAST(o.o_custkey % 13 + 1 AS INTEGER)] AS region,
         CAST(o.o_custkey AS VARCHAR) AS facility_id,
         CASE WHEN o.o_orderkey % 3 = 0 THEN NULL WHEN o.o_custkey % 19 = 0 THEN ''
              ELSE 'Facility ' || o.o_custkey END AS facility_name,
         CASE WHEN o.o_orderkey % 4 <> 0 THEN 'Agency ' || o.o_orderstatus END AS agency_name,
         'Type ' || (o.o_custkey % 5) AS place_type,
         'Sub ' || (o.o_custkey % 2) AS place_subtype,
         CASE WHEN o.o_custkey % 31 <> 0 THEN CAST(o.o_custkey % 90 AS DOUBLE) + 0.25 END AS latitude,
         -(CAST(o.o_custkey % 180 AS DOUBLE) + 0.5) AS longitude,
         'R' || o.o_custkey || '-1' AS reg_measure_id,
         'Permit' AS reg_measure_type,
         CASE WHEN o.o_orderkey % 53 = 0 THEN '' WHEN o.o_orderkey % 59 = 0 THEN NULL
              WHEN o.o_orderkey % 61 = 0 THEN lower(t.action_type) ELSE t.action_type END AS action_type,
         CASE WHEN o.o_orderkey % 53 = 0 OR o.o_orderkey % 59 = 0 THEN FALSE
              WHEN o.o_orderkey % 61 = 0 THEN TRUE
              ELSE o.o_orderpriority IN ('1-URGENT', '2-HIGH') END AS is_formal,
         CASE o.o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Historical' WHEN 'P' THEN 'Withdrawn' END AS status,
         'P' || (o.o_orderkey % 4) AS program,
         'Category ' || (o.o_custkey % 3) AS program_category,
         'Action ' || o.o_orderkey AS title,
         'Follow-up  for facility ' || o.o_custkey AS description,
         CASE WHEN o.o_orderkey % 20 IN (4, 9) THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS written_date,
         CASE WHEN o.o_orderkey % 20 IN (4, 9) OR o.o_orderkey % 5 = 3 THEN NULL
              ELSE CAST(o.o_orderdate AS DATE) END AS effective_date,
         CASE WHEN o.o_orderkey % 6 <> 0 THEN CAST(o.o_orderdate AS DATE) + 30 END AS adoption_date,
         CASE WHEN o.o_orderstatus = 'F'
              THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 400 AS INTEGER) END AS termination_date,
         CASE WHEN o.o_orderkey % 41 = 0 OR o.o_orderkey % 43 = 0 OR o.o_orderkey % 47 = 0 THEN NULL
              ELSE o.o_totalprice END AS assessed,
         p.liability, p.project, p.liability_paid, p.project_done, p.total_paid
  FROM orders o
  LEFT JOIN payments p ON o.o_orderkey = p.k
  LEFT JOIN (VALUES ('1-URGENT', 'Admin Civil Liability'), ('2-HIGH', 'Cease and Desist Order'),
                    ('3-MEDIUM', '13267 Letter'), ('4-NOT SPECIFIED', 'Notice of Violation'),
                    ('5-LOW', 'Oral Communication')) t(priority, action_type)
         ON o.o_orderpriority = t.priority
)"""

_ACTIONS = "actions AS (SELECT * FROM ordered WHERE wdid IS NOT NULL)"

_FACT = """
fact AS (
  SELECT *, COALESCE(assessed, 0) AS total_assessment_amount, COALESCE(total_paid, 0) AS total_paid_completed,
         CASE WHEN COALESCE(assessed, 0) > COALESCE(total_paid, 0)
              THEN COALESCE(assessed, 0) - COALESCE(total_paid, 0) ELSE 0 END AS outstanding_amount
  FROM actions
)"""

_REGISTRY = f"""
parties AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'WX' ELSE 'WD' END AS prefix, c_custkey AS n, c_nationkey AS nation,
         c_mktsegment AS segment, c_acctbal < 0 AS closed, c_custkey % 3 + 1 AS copies FROM customer
  UNION ALL
  SELECT 'WS', s_suppkey, s_nationkey, 'SUPPLY', FALSE, 1 FROM supplier
),
copied AS (
  SELECT p.*, c.copy, DATE '1990-01-01' + CAST((p.n * 7 + c.copy) % 9000 AS INTEGER) AS granted
  FROM parties p JOIN (VALUES (1), (2), (3)) c(copy) ON c.copy <= p.copies
),
registry AS (
  SELECT prefix || lpad(CAST(n AS VARCHAR), 8, '0') AS wdid,
         'R' || n || '-' || copy AS reg_measure_id,
         'Order ' || copy AS reg_measure_type,
         segment AS program_category,
         CAST(n AS VARCHAR) AS facility_id,
         CASE WHEN n % 17 <> 0 THEN {_REGION_LIST}[CAST((n + 1) % 13 + 1 AS INTEGER)] END AS facility_region,
         CASE WHEN n % 7 <> 0 OR copy > 1 THEN 'Site ' || n || ' #' || copy END AS facility_name,
         CASE WHEN n % 13 = 5 THEN NULL WHEN n % 11 = 0 THEN '' ELSE 'Place ' || (n % 7) END AS place_type,
         n || ' Main St' AS place_address,
         'City ' || nation AS place_city,
         lpad(CAST(n % 100000 AS VARCHAR), 5, '0') AS place_zip,
         'County ' || (nation % 7) AS place_county,
         CASE WHEN n % 31 <> 0 THEN CAST(n % 90 AS DOUBLE) + 0.75 END AS latitude,
         -(CAST(n % 180 AS DOUBLE) + 0.125) AS longitude,
         CASE WHEN closed THEN 'Historical' ELSE 'Active' END AS permit_status,
         CASE WHEN n % 4 <> 2 THEN granted END AS effective_date,
         CASE WHEN closed THEN granted + CAST(n % 700 AS INTEGER) END AS termination_date,
         granted - 30 AS adoption_date,
         strftime(granted, '00%y-%m-%d') AS review_date_text
  FROM copied
)"""

_REGISTRY_SIDE = """
registry_side AS (
  SELECT wdid, MIN(facility_name) AS facility_name, MIN(facility_region) AS region, MIN(place_type) AS place_type,
         MIN(latitude) AS latitude, MIN(longitude) AS longitude, MIN(place_county) AS county, MIN(place_city) AS city,
         MIN(place_zip) AS zip_code, MIN(place_address) AS place_address
  FROM registry GROUP BY wdid
)"""

_ACTION_SIDE = """
action_side AS (
  SELECT wdid, MIN(facility_name) AS facility_name, MIN(region) AS region, MIN(place_type) AS place_type,
         MIN(latitude) AS latitude, MIN(longitude) AS longitude, MIN(agency_name) AS agency_name
  FROM actions GROUP BY wdid
)"""

_FACILITIES = """
facilities AS (
  SELECT wdid, COALESCE(r.facility_name, a.facility_name) AS facility_name, a.agency_name,
         COALESCE(r.region, a.region) AS region, r.county, r.city, r.zip_code, r.place_address,
         COALESCE(r.place_type, a.place_type) AS place_type, COALESCE(r.latitude, a.latitude) AS latitude,
         COALESCE(r.longitude, a.longitude) AS longitude
  FROM registry_side r FULL OUTER JOIN action_side a USING (wdid)
)"""


def _money_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


_MART = f"""
months AS (
  SELECT wdid, CAST(DATE_TRUNC('month', effective_date) AS DATE) AS month,
         COUNT(*) AS enforcement_count,
         CAST(COUNT(*) FILTER (WHERE is_formal) AS BIGINT) AS formal_count,
         {_money_sum("total_assessment_amount")} AS total_assessment,
         {_money_sum("COALESCE(liability, 0)")} AS total_liability,
         {_money_sum("COALESCE(liability_paid, 0)")} AS total_paid,
         {_money_sum("outstanding_amount")} AS total_outstanding,
         CAST(COUNT(*) FILTER (WHERE status = 'Active') AS BIGINT) AS active_count
  FROM fact WHERE effective_date IS NOT NULL GROUP BY 1, 2
), mart AS (
  SELECT m.wdid, d.facility_name, d.agency_name, d.region, d.county, d.city, d.place_type, d.latitude, d.longitude,
         m.month, CAST(EXTRACT(YEAR FROM m.month) AS INTEGER) AS year, m.* EXCLUDE (wdid, month)
  FROM months m LEFT JOIN facilities d ON m.wdid = d.wdid
)"""

_SUMMARY = f"""
recent AS (SELECT CAST(MAX(effective_date) - INTERVAL 3 YEAR AS DATE) AS since FROM fact),
by_key AS (
  SELECT wdid, COUNT(*) AS total_actions, CAST(COUNT(*) FILTER (WHERE is_formal) AS BIGINT) AS formal_actions,
         CAST(COUNT(*) FILTER (WHERE effective_date >= (SELECT since FROM recent)) AS BIGINT) AS actions_last_3yr,
         MAX(effective_date) AS most_recent_action, MIN(effective_date) AS first_action,
         {_money_sum("total_assessment_amount")} AS total_assessed,
         {_money_sum("total_paid_completed")} AS total_paid,
         {_money_sum("outstanding_amount")} AS outstanding_balance
  FROM fact GROUP BY wdid
), summary AS (
  SELECT k.wdid, d.facility_name, d.region, d.county, d.place_type, k.* EXCLUDE (wdid)
  FROM by_key k JOIN facilities d ON k.wdid = d.wdid
)"""

_ORDER = "outstanding_balance DESC NULLS LAST, total_actions DESC NULLS LAST, most_recent_action DESC NULLS LAST, wdid"

_RANKED = f"""
ranked AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ORDER}) AS BIGINT) AS rank, wdid, facility_name, region, county, place_type,
         total_actions, formal_actions, actions_last_3yr, most_recent_action, first_action, total_assessed, total_paid,
         outstanding_balance
  FROM summary ORDER BY {_ORDER} LIMIT 25
)"""


def _case_label(column: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in labels.items())
    return f"CASE {column} {arms} ELSE {column} END"


def _rollup(labels: dict[str, str]) -> str:
    return f"""
rollup_rows AS (
  SELECT {_case_label("region", labels)} AS region, COUNT(DISTINCT wdid) AS facilities,
         CAST(SUM(enforcement_count) AS BIGINT) AS actions, {_money_sum("total_outstanding")} AS outstanding
  FROM mart WHERE region IS NOT NULL AND region <> 'NA' GROUP BY 1
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_UP_TO_ORDERED = (_PAYMENTS, _ORDERED)
_UP_TO_ACTIONS = (*_UP_TO_ORDERED, _ACTIONS)
_UP_TO_FACT = (*_UP_TO_ACTIONS, _FACT)
_UP_TO_FACILITIES = (*_UP_TO_FACT, _REGISTRY, _REGISTRY_SIDE, _ACTION_SIDE, _FACILITIES)
_UP_TO_MART = (*_UP_TO_FACILITIES, _MART)
_UP_TO_RANKED = (*_UP_TO_FACILITIES, _SUMMARY, _RANKED)

_REGISTRY_STAGED = """wdid, reg_measure_id, reg_measure_type, program_category, facility_id, facility_region,
  facility_name, place_type, place_address, place_city, place_zip, place_county, latitude, longitude, permit_status,
  effective_date, termination_date, adoption_date"""

_FACT_SELECT = """
SELECT enforcement_eid, wdid, reg_measure_id, action_type AS enforcement_action_type, is_formal, effective_date,
       adoption_date, termination_date, status, program, program_category, region, total_assessment_amount,
       COALESCE(liability, 0) AS liability_amount, COALESCE(liability_paid, 0) AS liability_paid,
       COALESCE(project, 0) AS project_amount, COALESCE(project_done, 0) AS project_completed, total_paid_completed,
       outstanding_amount, title, description
FROM fact"""

_SCHEMA_ROWS = ", ".join(
    f"('{table}', {position}, '{column}', 'string')"
    for table, columns in (("raw_permits_orders", REGISTRY_COLUMNS), ("raw_enforcement_actions", ACTION_COLUMNS))
    for position, column in enumerate(columns, start=1)
)

ORACLE: dict[str, str] = {
    "normalize_key": f"""{_with(*_UP_TO_ORDERED)}
SELECT order_number, CASE WHEN k % 89 <> 0 AND k % 97 = 0 THEN '' ELSE wdid END AS wdid FROM ordered""",
    "nonblank_key": f"""{_with(*_UP_TO_ACTIONS)} SELECT order_number, lower(wdid) AS wdid_text FROM actions""",
    "parse_money": f"""{_with(*_UP_TO_ORDERED)}
SELECT order_number, assessed AS total_assessment_amount, price AS initial_assessed_amount,
       total_paid AS total_paid_completed FROM ordered""",
    "parse_double": f"""{_with(*_UP_TO_ORDERED)} SELECT order_number, latitude, longitude FROM ordered""",
    "parse_date_registry": f"""{_with(_REGISTRY)}
SELECT wdid, reg_measure_id, effective_date, termination_date, adoption_date, review_date_text FROM registry""",
    "parse_date_actions": f"""{_with(*_UP_TO_ORDERED)}
SELECT order_number, effective_date, written_date AS effective_date_pivot, adoption_date, termination_date
FROM ordered""",
    "floor_date": f"""{_with(*_UP_TO_ORDERED)} SELECT order_number, effective_date AS floored_date FROM ordered""",
    "action_formality": f"""{_with(*_UP_TO_ORDERED)} SELECT order_number, action_type, is_formal FROM ordered""",
    "outstanding_per_action": f"""{_with(*_UP_TO_FACT)}
SELECT order_number, CAST(outstanding_amount AS DOUBLE) AS outstanding_amount FROM fact""",
    "month_year": f"""{_with(*_UP_TO_ACTIONS)}
SELECT order_number, CAST(DATE_TRUNC('month', effective_date) AS DATE) AS month,
       CAST(EXTRACT(YEAR FROM effective_date) AS INTEGER) AS year
FROM actions WHERE effective_date IS NOT NULL""",
    "region_label": f"""{_with(*_UP_TO_FACILITIES)}
SELECT wdid, region, {_case_label("region", OFFICE_LABELS)} AS label FROM facilities""",
    "region_parent_label": f"""{_with(*_UP_TO_FACILITIES)}
SELECT wdid, region, {_case_label("region", PARENT_LABELS)} AS label FROM facilities""",
    "stage_registry": f"""{_with(_REGISTRY)} SELECT {_REGISTRY_STAGED} FROM registry""",
    "stage_actions": f"""{_with(*_UP_TO_ACTIONS)}
SELECT wdid, enforcement_eid, region, facility_id, facility_name, agency_name, place_type, place_subtype, latitude,
       longitude, reg_measure_id, reg_measure_type, order_number AS order_resolution_number,
       action_type AS enforcement_action_type, status, program, program_category, title, description, effective_date,
       adoption_date, termination_date, assessed AS total_assessment_amount, price AS initial_assessed_amount,
       liability AS liability_amount, project AS project_amount, liability_paid, project_done AS project_completed,
       total_paid AS total_paid_completed
FROM actions""",
    "key_spine": f"""{_with(*_UP_TO_ACTIONS, _REGISTRY)}
SELECT wdid FROM registry UNION SELECT wdid FROM actions""",
    "registry_representative": f"""{_with(_REGISTRY, _REGISTRY_SIDE)} SELECT * FROM registry_side""",
    "actions_representative": f"""{_with(*_UP_TO_ACTIONS, _ACTION_SIDE)} SELECT * FROM action_side""",
    "dim_facility": f"""{_with(*_UP_TO_FACILITIES)} SELECT * FROM facilities""",
    "dim_action_type": f"""{_with(*_UP_TO_ACTIONS)}
SELECT DISTINCT action_type AS enforcement_action_type,
       action_type NOT IN ('13267 Letter', 'Notice of Violation', 'Oral Communication') AS is_formal
FROM actions WHERE action_type <> ''""",
    "fact_actions": _with(*_UP_TO_FACT) + _FACT_SELECT,
    "fact_actions_by_lookup": _with(*_UP_TO_FACT) + _FACT_SELECT,
    "mart_monthly": f"""{_with(*_UP_TO_MART)} SELECT * FROM mart""",
    "mart_without_year": f"""{_with(*_UP_TO_MART)} SELECT * EXCLUDE (year) FROM mart""",
    "formal_counts": f"""{_with(*_UP_TO_ACTIONS)}
SELECT wdid, COUNT(*) AS total_actions, CAST(SUM(CASE WHEN is_formal THEN 1 ELSE 0 END) AS BIGINT) AS formal_actions
FROM actions GROUP BY wdid""",
    "recent_window_count": f"""{_with(*_UP_TO_ACTIONS)}
SELECT wdid, CAST(SUM(CASE WHEN effective_date >= newest.cutoff THEN 1 ELSE 0 END) AS BIGINT) AS actions_last_3yr
FROM actions
CROSS JOIN (SELECT CAST(MAX(effective_date) - INTERVAL 3 YEAR AS DATE) AS cutoff FROM actions) newest
GROUP BY wdid""",
    "facility_summary": f"""{_with(*_UP_TO_FACILITIES, _SUMMARY)} SELECT * FROM summary""",
    "priority": f"""{_with(*_UP_TO_RANKED)} SELECT * FROM ranked""",
    "priority_read": f"""{_with(*_UP_TO_RANKED)} SELECT * FROM ranked ORDER BY rank""",
    "priority_display": f"""{_with(*_UP_TO_RANKED)}
SELECT rank AS "Rank", facility_name AS "Facility", {_case_label("region", OFFICE_LABELS)} AS "Region",
       county AS "County", total_actions AS "Total actions", formal_actions AS "Formal actions",
       actions_last_3yr AS "Actions (last 3yr)", strftime(most_recent_action, '%Y-%m-%d') AS "Most recent",
       format('${{:,.0f}}', total_assessed) AS "Assessed", format('${{:,.0f}}', total_paid) AS "Paid",
       format('${{:,.0f}}', outstanding_balance) AS "Outstanding"
FROM ranked""",
    "priority_bar_order": f"""{_with(*_UP_TO_RANKED)}
SELECT facility_name, outstanding_balance FROM ranked ORDER BY outstanding_balance""",
    "kpi_totals": f"""{_with(*_UP_TO_MART)}
SELECT COUNT(DISTINCT wdid) AS total_facilities, CAST(SUM(enforcement_count) AS BIGINT) AS total_actions,
       {_money_sum("total_assessment")} AS total_assessed, {_money_sum("total_outstanding")} AS total_outstanding
FROM mart""",
    "region_rollup": f"""{_with(*_UP_TO_MART, _rollup(PARENT_LABELS))} SELECT * FROM rollup_rows""",
    "suboffice_rollup": f"""{_with(*_UP_TO_MART, _rollup(OFFICE_LABELS))} SELECT * FROM rollup_rows""",
    "region_display": f"""{_with(*_UP_TO_MART, _rollup(OFFICE_LABELS))}
SELECT region AS "Region", facilities AS "Facilities", actions AS "Total actions",
       format('${{:,.0f}}', outstanding) AS "Outstanding balance"
FROM rollup_rows""",
    "key_match_profile": f"""{_with(*_UP_TO_ACTIONS, _REGISTRY)}, matches AS (
  SELECT CAST(SUM(CASE WHEN r.wdid IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS matched, COUNT(*) AS total
  FROM actions a LEFT JOIN (SELECT DISTINCT wdid FROM registry) r ON a.wdid = r.wdid
)
SELECT matched, total, total - matched AS unmatched, CAST(matched AS DOUBLE) / total AS match_rate FROM matches""",
    "layer_row_counts": f"""{_with(*_UP_TO_MART, _SUMMARY, _RANKED)}
SELECT 'raw_permits_orders' AS layer, COUNT(*) AS rows FROM registry
UNION ALL SELECT 'raw_enforcement_actions', COUNT(*) FROM ordered
UNION ALL SELECT 'stg_permits', COUNT(*) FROM registry
UNION ALL SELECT 'stg_enforcement', COUNT(*) FROM actions
UNION ALL SELECT 'dim_facility', COUNT(*) FROM facilities
UNION ALL SELECT 'dim_action_type', COUNT(DISTINCT action_type) FROM actions WHERE action_type <> ''
UNION ALL SELECT 'fact_enforcement', COUNT(*) FROM fact
UNION ALL SELECT 'mart_facility_monthly', COUNT(*) FROM mart
UNION ALL SELECT 'priority_facilities', COUNT(*) FROM ranked""",
    "schema_snapshot": f"""{_with(_REGISTRY)}, counted AS (
  SELECT 'raw_permits_orders' AS name, COUNT(*) AS n FROM registry
  UNION ALL SELECT 'raw_enforcement_actions', COUNT(*) FROM orders
)
SELECT s."table", CAST(s.position AS INTEGER) AS position, s."column", s."type", c.n AS rows
FROM (VALUES {_SCHEMA_ROWS}) s("table", position, "column", "type") JOIN counted c ON s."table" = c.name""",
    "quality_report": f"""{_with(*_UP_TO_FACILITIES)}
SELECT 'action_rows' AS "check", COUNT(*) AS result FROM ordered
UNION ALL SELECT 'key_missing', COUNT(*) FROM ordered WHERE wdid IS NULL
UNION ALL SELECT 'fact_rows', COUNT(*) FROM fact
UNION ALL SELECT 'zero_assessment', COUNT(*) FROM fact WHERE total_assessment_amount = 0
UNION ALL SELECT 'zero_outstanding', COUNT(*) FROM fact WHERE outstanding_amount = 0
UNION ALL SELECT 'negative_before_floor', COUNT(*) FROM fact WHERE total_assessment_amount < total_paid_completed
UNION ALL SELECT 'implausible_amounts', COUNT(*) FROM fact
          WHERE greatest(abs(total_assessment_amount), abs(total_paid_completed), abs(liability), abs(liability_paid),
                         abs(project), abs(project_done)) >= 1e27
UNION ALL SELECT 'region_codes', COUNT(DISTINCT region) FROM facilities WHERE region <> 'NA'
UNION ALL SELECT 'registry_only_without_region', COUNT(*) FROM facilities
          WHERE region = 'NA' AND wdid NOT IN (SELECT wdid FROM actions)
UNION ALL SELECT 'duplicate_ids', COUNT(*) FROM (
          SELECT enforcement_eid FROM fact GROUP BY enforcement_eid HAVING COUNT(*) > 1) repeated
UNION ALL SELECT 'facilities_without_registry_row', COUNT(DISTINCT wdid) FROM actions
          WHERE wdid NOT IN (SELECT wdid FROM registry)""",
    "duplicate_ids": f"""{_with(*_UP_TO_ACTIONS)}
SELECT enforcement_eid, COUNT(*) AS occurrences FROM actions GROUP BY enforcement_eid HAVING COUNT(*) > 1""",
}
# A CSV file doesn't tell an empty text from none: both are read as NULL.
ORACLE["csv_round_trip"] = f"""SELECT * REPLACE (nullif(place_type, '') AS place_type,
       nullif(facility_name, '') AS facility_name) FROM ({ORACLE["stage_registry"]}) staged"""
ORACLE["csv_tolerant_round_trip"] = f"""SELECT * REPLACE (nullif(facility_name, '') AS facility_name,
       nullif(enforcement_action_type, '') AS enforcement_action_type) FROM ({ORACLE["stage_actions"]}) staged"""
ORACLE["csv_repair_round_trip"] = ORACLE["csv_tolerant_round_trip"]


def _line(text: tuple[str, ...], columns: tuple[str, ...]) -> str:
    """A CSV line: texts quoted where they are empty, nothing for NULL, numbers as DuckDB writes them."""
    cells = (
        f"COALESCE(CASE WHEN {c} = '' THEN '\"\"' ELSE {c} END, '')" if c in text else f"COALESCE(CAST({c} AS VARCHAR), '')"
        for c in columns
    )
    return " || ',' || ".join(cells)


_MART_TEXT = ("wdid", "facility_name", "agency_name", "region", "county", "city", "place_type")
_MART_COLUMNS = (
    *_MART_TEXT, "latitude", "longitude", "month", "year", "enforcement_count", "formal_count", "total_assessment",
    "total_liability", "total_paid", "total_outstanding", "active_count",
)
_RANKED_COLUMNS = (
    "rank", "wdid", "facility_name", "region", "county", "place_type", "total_actions", "formal_actions", "actions_last_3yr",
    "most_recent_action", "first_action", "total_assessed", "total_paid", "outstanding_balance",
)
ORACLE["mart_export_lines"] = f"""SELECT {_line(_MART_TEXT, _MART_COLUMNS)} AS text FROM ({ORACLE["mart_monthly"]}) mart"""
ORACLE["priority_export_lines"] = f"""SELECT 0 AS line, '{",".join(_RANKED_COLUMNS)}' AS text UNION ALL
SELECT CAST(row_number() OVER (ORDER BY outstanding_balance DESC NULLS LAST, rank) AS INTEGER),
       {_line(_MART_TEXT, _RANKED_COLUMNS)} FROM ({ORACLE["priority"]}) ranked"""
ORACLE["kpis_by_bitmaps"] = f"""SELECT total_facilities, total_actions, total_outstanding FROM ({ORACLE["kpi_totals"]}) totals"""
ORACLE["region_rollup_by_bitmaps"] = ORACLE["region_rollup"]
ORACLE["suboffice_rollup_by_bitmaps"] = ORACLE["suboffice_rollup"]
ORACLE["mart_in_two_loads"] = ORACLE["mart_monthly"]
ORACLE["summary_in_two_loads"] = ORACLE["facility_summary"]
ORACLE["display_texts"] = f"""WITH counted AS (
  SELECT wdid, CAST(SUM(enforcement_count) AS BIGINT) AS actions FROM ({ORACLE["mart_monthly"]}) mart GROUP BY wdid)
SELECT wdid, '$' || actions || '.0M' AS millions, actions || ',000' AS thousands,
       (100 * actions // 8) || CASE WHEN actions % 2 = 0 THEN '.0%' ELSE '.5%' END AS eighths
FROM counted"""
