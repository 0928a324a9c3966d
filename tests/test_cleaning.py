from __future__ import annotations

import math
import random
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from docketrank import functions as fx
from docketrank.functions.dates import ACTION_DATE_FLOOR

KEYS = [" ab1 ", "AB1", "\u00a0ab1\u00a0", "\tab1", "   ", "", None, "2 417", "\u2003\u3000x\u202f ", "\u00e9 "]


def test_trim_strips_every_space_separator_and_no_tab(values):
    assert values(fx.trim_text, KEYS) == ["ab1", "AB1", "ab1", "\tab1", "", "", None, "2 417", "x", "\u00e9"]


def test_normalize_key_is_upper_case(values):
    assert values(fx.normalize_key, KEYS)[:4] == ["AB1", "AB1", "AB1", "\tAB1"]


def test_nonblank(values):
    assert values(fx.is_nonblank, KEYS) == [True, True, True, True, False, False, None, True, True, True]


@pytest.mark.parametrize("function, sql", [(fx.trim_text, "trim(t)"), (fx.normalize_key, "upper(trim(t))")])
def test_trim_as_the_sql_engine_does(values, function, sql):
    separators = [chr(c) for c in (0x20, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x202F, 0x205F, 0x3000, 0x9)]
    texts = [f"{s}a{s}b{s}" for s in separators]
    expected = [duckdb.execute(f"SELECT {sql} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in texts]
    assert values(function, texts) == expected


MONEY = {
    "$1,234.50": 1234.5,
    " 7 ": 7.0,
    "\u00a0$7\u00a0": 7.0,
    "(500)": None,
    "-5": -5.0,
    "$-5": -5.0,
    "+5": 5.0,
    "1d": None,
    "1f": None,
    "0x10": None,
    "1_000": 1000.0,
    "1__000": None,
    "": None,
    "N/A": None,
    "1e3": 1000.0,
    "1e": None,
    ".5": 0.5,
    "5.": 5.0,
    ".": None,
    "$": None,
    "1.5.5": None,
    "$ 500": 500.0,
    "$\u00a0500": None,
    "5 5": None,
    "\t5\n": 5.0,
    "12\n13": None,
}


def test_parse_money(values):
    texts = [*MONEY, None, "inf", "nan", "1e400"]
    assert values(fx.parse_money, texts) == [*MONEY.values(), None, None, None, None]


def test_money_as_the_sql_engine_does(values):
    sql = "SELECT try_cast(replace(replace(trim(?), '$', ''), ',', '') AS DOUBLE)"
    assert values(fx.parse_money, list(MONEY)) == [duckdb.execute(sql, [t]).fetchone()[0] for t in MONEY]


def test_parse_double_keeps_infinities(values):
    got = values(fx.parse_double, ["inf", "-Infinity", "nan", "-nan", "1e400", "infinit", "1_0.0_1", "\u00a05", None])
    assert got[:2] == [math.inf, -math.inf]
    assert math.isnan(got[2]) and math.isnan(got[3])
    assert got[4:] == [math.inf, None, 10.01, None, None]


DATES = [
    "12/29/2016", "1/5/2016", "2016-12-29", "2016-1-5", "12/29/16", "12/29/69", "02/30/2016", "13/01/2016",
    "12/29/2016 00:00", "2016-12-29T00:00", "2016-12-29 x", "N/A", "", "2016", "2016-12", "5/6", "1/2/3/2016",
    "16-1-5", " 1/5/2016 ", "\u00a01/5/2016\u00a0", "1/5/2016\n", "\t2016-01-05", "1/ 5/2016", "1 /5/2016", "1/5 /2016",
    "001/1/2016", "12/29/20166", "12/29/201", "+1/5/2016", "1/5/-2016", "2016/1/5", "02/29/2016", "02/29/1900",
    "\t\u00a01/5/2016", "\u00a0\t1/5/2016", "0016-1-5", "1/5/1", "-5-6", "--", "//",
]


def _sql_date(text, forms):
    tries = ", ".join(f"try_strptime(trim(t), '{form}')::DATE" for form in forms)
    return duckdb.execute(f"SELECT COALESCE({tries}) FROM (SELECT ? AS t)", [text]).fetchone()[0]


def test_dates_as_the_sql_engine_reads_them(values):
    assert values(fx.parse_date, DATES) == [_sql_date(t, ["%m/%d/%Y", "%Y-%m-%d"]) for t in DATES]


def test_floored_dates_as_the_sql_engine_reads_them(values):
    expected = [_sql_date(t, ["%m/%d/%Y", "%m/%d/%y", "%Y-%m-%d"]) for t in DATES]
    expected = [d if d is not None and d >= ACTION_DATE_FLOOR else None for d in expected]
    assert values(lambda t: fx.parse_date(t, ACTION_DATE_FLOOR), DATES) == expected
    assert date(2016, 12, 29) in expected and expected[DATES.index("12/29/16")] is None


def test_two_digit_years_by_pivot(values):
    texts = ["12/29/16", "12/29/68", "12/29/69", "1/5/99", "1/5/00", "1/5/7", "1/5/201", "1/5/2016", "2016-1-5", "N/A"]
    got = values(lambda t: fx.parse_date(t, ACTION_DATE_FLOOR, two_digit_year="pivot"), texts)
    assert got == [
        date(2016, 12, 29), date(2068, 12, 29), date(1969, 12, 29), date(1999, 1, 5), date(2000, 1, 5),
        date(2007, 1, 5), None, date(2016, 1, 5), date(2016, 1, 5), None,
    ]
    with pytest.raises(ValueError):
        fx.parse_date(None, two_digit_year="guess")


def test_floor_is_inclusive(values):
    days = [date(1899, 12, 31), date(1900, 1, 1), None]
    assert values(fx.floor_date, days, "date") == [None, date(1900, 1, 1), None]


def test_calendar_steps(values):
    assert values(lambda d: fx.years_before(d, 3), [date(2020, 2, 29), date(2020, 3, 1)], "date") == [
        date(2017, 2, 28),
        date(2017, 3, 1),
    ]
    assert values(fx.month_start, [date(2020, 2, 29), None], "date") == [date(2020, 2, 1), None]
    assert values(fx.calendar_year, [date(2020, 2, 29), None], "date") == [2020, None]


def test_display_texts(values):
    amounts = [2.5, 3.5, 1234567.0, -5.0, 0.0]
    assert values(fx.currency_text, amounts, "double") == [f"${x:,.0f}" for x in amounts]
    assert values(fx.millions_text, [12_340_000.0], "double") == ["$12.3M"]
    assert values(fx.count_text, [1234567], "long") == ["1,234,567"]
    assert values(fx.percent_text, [0.8638], "double") == ["86.4%"]
    assert values(fx.date_text, [date(2016, 1, 5), None], "date") == ["2016-01-05", None]


def test_exact_sum_keeps_cents_and_large_amounts(spark):
    amounts = [("a", 0.1)] * 10 + [("a", 724771.09), ("b", -0.05), ("b", 0.05), ("c", 1e17), ("c", 0.25), ("d", None)]
    df = spark.createDataFrame(amounts, "k string, v double").repartition(5)
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(fx.exact_sum(df.v).alias("s")).collect()}
    assert got == {"a": 724772.09, "b": 0.0, "c": 1e17, "d": None}
    assert df.where("k = 'a'").agg(fx.exact_total(df.v).alias("s")).first()["s"] == 724772.09


def test_money_sums_have_no_cliff(spark):
    """Junk and huge amounts neither stop a sum nor make it depend on the order of the rows."""
    amounts = [1e30, -1e300] + [9e14] * 120 + [1e15, 1e15 + 0.25, 123456789012345.67, 0.1, 0.2, -0.3, -5e20, 5e20] + [None] * 3
    results = set()
    for seed in range(4):
        rows = [(a,) for a in random.Random(seed).sample(amounts, len(amounts))]
        df = spark.createDataFrame(rows, "v double").repartition(5 + seed)
        sums = df.agg(fx.exact_sum(df.v).alias("s"), fx.exact_total(df.v).alias("t"), F.sum(fx.implausible(df.v).cast("int")).alias("n"))
        row = sums.first()
        results.add((row["s"], row["n"]))
    assert results == {(9e14 * 120 + 1e15 + 1e15 + 0.25 + 123456789012345.67, 2)}
    assert spark.createDataFrame([(None,)], "v double").agg(fx.exact_sum(F.col("v")).alias("s")).first()["s"] is None
