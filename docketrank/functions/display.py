"""Presentation text for reports; only ever applied to final, small results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def currency_text(amount: Column) -> Column:
    """``$1,234``; halves go to the even dollar."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def millions_text(amount: Column) -> Column:
    return F.format_string("$%.1fM", amount / 1e6)


def count_text(count: Column) -> Column:
    return F.format_number(count, 0)


def percent_text(ratio: Column) -> Column:
    return F.format_string("%.1f%%", ratio * 100)


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def map_label(code: Column, labels: Mapping[str, str]) -> Column:
    """The label of a code, or the code itself where the table has none."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)
