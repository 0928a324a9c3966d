"""Messy text extracts derived from order tables, for queries without the public CSV files.

Every order becomes one raw action row, every customer (in one to three copies) and every
supplier a raw registry row; no row of a table is left out. The arithmetic on ids below only
chooses how a value is written: which date format, padded or blank, readable or junk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketrank.functions import exact_sum
from docketrank.sources.schemas import ACTION_COLUMNS, REGISTRY_COLUMNS

# The region codes dealt out over facilities.
REGION_CODES = "array('1', '2', '3', '4', '5S', '5F', '5R', '6A', '6B', '7', '8', '9', 'NA')"

# Order priority -> action type (the last three informal), order status -> status.
ACTION_TYPES = """map(
    '1-URGENT', 'Admin Civil Liability',
    '2-HIGH', 'Cease and Desist Order',
    '3-MEDIUM', '13267 Letter',
    '4-NOT SPECIFIED', 'Notice of Violation',
    '5-LOW', 'Oral Communication')"""
STATUSES = "map('O', 'Active', 'F', 'Historical', 'P', 'Withdrawn')"

# How an action column is written, in terms of an order: k and c are order and customer number,
# day the order date, iso its text, pad a blank or a no-break space. Columns not listed are NULL.
ACTION_TEXT = {
    "REGION": f"' ' || {REGION_CODES}[c % 13]",
    "FACILITY ID": "c",
    "FACILITY NAME": "CASE WHEN k % 3 = 0 THEN NULL WHEN c % 19 = 0 THEN '' ELSE 'Facility ' || c || ' ' END",
    "AGENCY NAME": "CASE WHEN k % 4 <> 0 THEN 'Agency ' || o_orderstatus END",
    "PLACE TYPE": "'Type ' || (c % 5)",
    "PLACE SUBTYPE": "pad || 'Sub ' || (c % 2)",
    "PLACE LATITUDE": "CASE WHEN c % 31 = 0 THEN 'bad' ELSE ' ' || (c % 90) || '.25' END",
    "PLACE LONGITUDE": "'-' || (c % 180) || '.5 '",
    "WDID": """CASE WHEN k % 89 = 0 THEN NULL WHEN k % 97 = 0 THEN '   '
                    ELSE pad || 'wd' || lpad(c, 8, '0') || pad END""",
    "REG MEASURE ID": "'R' || c || '-1'",
    "REG MEASURE TYPE": "' Permit'",
    "ENFORCEMENT ID (EID)": "'  E' || CASE WHEN k % 211 = 0 THEN k + 1 ELSE k END || ' '",
    "ORDER / RESOLUTION NUMBER": "'ORD-' || k",
    "ENFORCEMENT ACTION TYPE": f"""CASE WHEN k % 53 = 0 THEN '' WHEN k % 59 = 0 THEN NULL
                    WHEN k % 61 = 0 THEN lower({ACTION_TYPES}[o_orderpriority])
                    ELSE {ACTION_TYPES}[o_orderpriority] || pad END""",
    "EFFECTIVE DATE": """CASE WHEN k % 20 = 4 THEN 'N/A' WHEN k % 20 = 9 THEN NULL
                    WHEN k % 5 = 1 THEN substr(iso, 6, 2) || '/' || substr(iso, 9, 2) || '/' || year(day)
                    WHEN k % 5 = 2 THEN iso
                    WHEN k % 5 = 3 THEN substr(iso, 6, 2) || '/' || substr(iso, 9, 2) || '/' || substr(iso, 3, 2)
                    ELSE pad || month(day) || '/' || day(day) || '/' || year(day) END""",
    "ADOPTION / ISSUANCE DATE": """CASE WHEN k % 6 = 0 THEN ''
                    ELSE '  ' || date_format(date_add(day, 30), 'MM/dd/yyyy') || ' ' END""",
    "TERMINATION DATE": """CASE WHEN o_orderstatus = 'F'
                    THEN date_add(day, CAST(k % 400 AS INT)) END""",
    "STATUS": f"{STATUSES}[o_orderstatus] || pad",
    "TITLE": "' Action ' || k || ' '",
    "DESCRIPTION": "'\u00a0 Follow-up  for facility ' || c || pad",
    "PROGRAM": "'P' || (k % 4)",
    "PROGRAM CATEGORY": "'Category ' || (c % 3)",
    "TOTAL ASSESSMENT AMOUNT": """CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN 'pending'
                    WHEN k % 47 = 0 THEN '(' || format_number(o_totalprice, 2) || ')'
                    ELSE '$' || format_number(o_totalprice, 2) END""",
    "INITIAL ASSESSED AMOUNT": "' ' || CAST(o_totalprice AS DECIMAL(18,2)) || ' '",
    "LIABILITY $ AMOUNT": "coalesce('$' || CAST(liability AS DECIMAL(18,2)), '')",
    "PROJECT $ AMOUNT": "coalesce('$' || CAST(project AS DECIMAL(18,2)), '')",
    "LIABILITY $ PAID": "coalesce('$' || CAST(liability_paid AS DECIMAL(18,2)), '')",
    "PROJECT $ COMPLETED": "coalesce('$' || CAST(project_done AS DECIMAL(18,2)), '')",
    "TOTAL $ PAID/COMPLETED AMOUNT": "coalesce('$' || format_number(total_paid, 2), '')",
    "Location 1": "'(' || (c % 90) || '.25, -' || (c % 180) || '.5)'",
}

# How a registry column is written, in terms of a party: n its number, copy the permit, granted
# a day that follows from both. Columns not listed are NULL.
REGISTRY_TEXT = {
    "reg_measure_id": "'R' || n || '-' || copy",
    "reg_measure_type": "' Order ' || copy",
    "order_number": "'N-' || n",
    "program_category": "segment",
    "wdid": "' ' || prefix || lpad(n, 8, '0')",
    "status": "CASE WHEN closed THEN 'Historical ' ELSE 'Active ' END",
    "effective_date": """CASE n % 4 WHEN 0 THEN date_format(granted, 'M/d/yyyy')
                    WHEN 1 THEN date_format(granted, 'yyyy-MM-dd') WHEN 2 THEN 'N/A'
                    ELSE ' ' || date_format(granted, 'MM/dd/yyyy') || ' ' END""",
    "expiration_review_date": "date_format(granted, 'MM/dd/yy')",
    "termination_date": """CASE WHEN closed
                    THEN date_format(date_add(granted, CAST(n % 700 AS INT)), 'yyyy-M-d') END""",
    "adoption_date": "date_format(date_sub(granted, 30), 'M/d/yyyy')",
    "number_of_amendments": "copy",
    "facility_id": "n || ' '",
    "facility_region": f"CASE WHEN n % 17 <> 0 THEN {REGION_CODES}[(n + 1) % 13] || ' ' END",
    "facility_name": "CASE WHEN n % 7 <> 0 OR copy > 1 THEN 'Site ' || n || ' #' || copy END",
    "place_type": "CASE WHEN n % 13 = 5 THEN NULL WHEN n % 11 = 0 THEN '' ELSE 'Place ' || (n % 7) END",
    "place_address": "n || ' Main St'",
    "place_city": "'City ' || nation",
    "place_zip": "lpad(n % 100000, 5, '0')",
    "place_county": "'County ' || (nation % 7)",
    "latitude_decimal_degrees": "CASE WHEN n % 31 = 0 THEN 'bad' ELSE (n % 90) || '.75' END",
    "longitude_decimal_degrees": "'-' || (n % 180) || '.125'",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal out a table by its key.

    Writing and reading text costs far more than scanning, so a small one-file table would keep a single
    core busy. A join by the key finds its rows where they are then.
    """
    return df.repartition(key)


def _written(rows: DataFrame, columns: tuple[str, ...], how: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*(f"CAST({how.get(name, 'NULL')} AS STRING) AS `{name}`" for name in columns))


def order_payments(lineitem: DataFrame) -> DataFrame:
    """Money per order by line status and return flag; NULL where an order has no such line."""
    status, flag, price = F.col("l_linestatus"), F.col("l_returnflag"), F.col("l_extendedprice")
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        exact_sum(F.when((status == "F") & (flag == "A"), price)).alias("total_paid"),
        exact_sum(F.when((status == "F") & (flag == "R"), price)).alias("liability"),
        exact_sum(F.when((status == "F") & (flag == "N"), price)).alias("liability_paid"),
        exact_sum(F.when(status == "O", price)).alias("project"),
        exact_sum(F.when((status == "O") & (flag == "N"), price)).alias("project_done"),
    )


def raw_actions(spark: SparkSession, folder: str) -> DataFrame:
    """The action log: 32 text columns, one row per order."""
    payments = order_payments(table(spark, folder, "lineitem"))
    orders = spread(table(spark, folder, "orders"), "o_orderkey").join(payments, "o_orderkey", "left")
    rows = orders.selectExpr(
        "*",
        "o_orderkey AS k",
        "o_custkey AS c",
        "CAST(o_orderdate AS DATE) AS day",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso",
        "CASE WHEN o_orderkey % 5 = 0 THEN '\u00a0' ELSE ' ' END AS pad",
    )
    return _written(rows, ACTION_COLUMNS, ACTION_TEXT)


def raw_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry: 40 text columns; customers in debt are listed under a closed code."""
    customers = spread(table(spark, folder, "customer"), "c_custkey").selectExpr(
        "CASE WHEN c_acctbal < 0 THEN 'WX' ELSE 'WD' END AS prefix",
        "c_custkey AS n",
        "c_nationkey AS nation",
        "c_mktsegment AS segment",
        "c_acctbal < 0 AS closed",
        "explode(sequence(1, c_custkey % 3 + 1)) AS copy",
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "'WS' AS prefix", "s_suppkey AS n", "s_nationkey AS nation", "'SUPPLY' AS segment", "false AS closed", "1L AS copy"
    )
    rows = customers.union(suppliers).selectExpr(
        "*", "date_add(DATE '1990-01-01', CAST((n * 7 + copy) % 9000 AS INT)) AS granted"
    )
    return _written(rows, REGISTRY_COLUMNS, REGISTRY_TEXT)
