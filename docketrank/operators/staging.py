"""Raw text rows to typed rows, driven by a column specification."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from docketrank.functions import floor_date, is_nonblank, normalize_key, parse_date, parse_double, trim_text
from docketrank.functions.dates import ACTION_DATE_FLOOR
from docketrank.functions.money import clean_money_text, finite_number
from docketrank.sources.schemas import ACTION_STAGING, REGISTRY_STAGING, Staged


ByKind = dict[str, Callable[[Column], Column]]


def raw_column(name: str) -> Column:
    """A raw column by its exact name, whatever signs the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def stage(
    raw: DataFrame, columns: Iterable[Staged], date_floor: date | None = None, two_digit_year: str = "literal"
) -> DataFrame:
    """Keep rows with a non-blank key and read every column by its kind.

    Three projections (clean, read, guard) and no shuffle. Each step names its result, so the
    next one reuses it instead of computing it again per mention; a reader that uses three
    staged columns still makes the scan read three raw ones.
    """
    columns = tuple(columns)
    clean: ByKind = {"key": normalize_key, "text": trim_text, "money": clean_money_text}
    read: ByKind = {
        "number": parse_double,
        "money": finite_number,
        "date": lambda text: parse_date(text, two_digit_year=two_digit_year),
    }
    guard: ByKind = {} if date_floor is None else {"date": lambda day: floor_date(day, date_floor)}

    def step(rows: DataFrame, change: ByKind) -> DataFrame:
        changed = {c.name: change[c.kind](F.col(c.name)) for c in columns if c.kind in change}
        return rows.withColumns(changed) if changed else rows

    rows = raw.select(*(raw_column(c.raw).alias(c.name) for c in columns))
    for column in columns:
        if column.kind == "key":
            rows = rows.where(is_nonblank(F.col(column.name)))
    return step(step(step(rows, clean), read), guard)


def stage_registry(raw: DataFrame) -> DataFrame:
    """Typed registry rows; its dates have no floor."""
    return stage(raw, REGISTRY_STAGING)


def stage_actions(raw: DataFrame, two_digit_year: str = "literal") -> DataFrame:
    """Typed action rows; days before the floor are NULL."""
    return stage(raw, ACTION_STAGING, ACTION_DATE_FLOOR, two_digit_year)
