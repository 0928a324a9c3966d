"""Numbers and money from text, and sums that do not depend on row order.

Parsing comes in small steps (clean, then read) because a Column has no local variables: a
step written as its own projection is computed once per row, while the same steps nested in one
expression repeat the inner ones for every mention. ``operators.staging`` uses the steps;
``parse_money`` is the one-expression form for a single column.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docketrank.functions.text import trim_text

# Digits may be grouped by single underscores; Java's own extras (trailing d or f, hex) are out.
_DIGITS = r"\d++(?:_\d++)*+"
NUMBER_PATTERN = rf"\A\s*+[+-]?(?:{_DIGITS}\.?+(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?\d++)?\s*+\z"
# Nearly every number looks like this, and the check is several times cheaper. So few digits
# cannot overflow a double.
_COMMON_NUMBER = r"\A\d{1,300}+(?:\.\d++)?+\z"
INFINITY_PATTERN = r"(?i)^\s*+[+-]?inf(?:inity)?\s*+$"
NAN_PATTERN = r"(?i)^\s*+[+-]?nan\s*+$"

# A double holds every cent below this; larger amounts are summed as decimals.
_EXACT_CENTS_BELOW = 2.0**46
# Junk in a register, not money: left out of sums, and counted by ``implausible``. A decimal of 38
# digits holds the sum of a thousand million such amounts.
PLAUSIBLE_BELOW = 1e27


def _number(text: Column, finite_only: bool) -> Column:
    # The patterns come first because the cast builds an exception for every text it refuses.
    unusual = F.replace(text, F.lit("_")).try_cast("double")
    if finite_only:
        unusual = F.when(F.abs(unusual) < float("inf"), unusual)
    return F.when(text.rlike(_COMMON_NUMBER), text.try_cast("double")).when(text.rlike(NUMBER_PATTERN), unusual)


def finite_number(text: Column) -> Column:
    """A plain decimal number from text, NULL for everything else.

    A number too large for a double is NULL too; no exact sum could hold it.
    """
    return _number(text, finite_only=True)


def parse_double(text: Column) -> Column:
    """Text to double; anything that is not a number is NULL, infinities and NaN pass."""
    special = F.when(text.rlike(INFINITY_PATTERN), text.try_cast("double")).when(
        text.rlike(NAN_PATTERN), F.lit(float("nan"))
    )
    return F.coalesce(_number(text, finite_only=False), special)


def clean_money_text(text: Column) -> Column:
    """Trimmed, without ``$`` and thousands commas."""
    return F.replace(F.replace(trim_text(text), F.lit("$")), F.lit(","))


def parse_money(text: Column) -> Column:
    """Currency text to double; bracketed negatives, infinities and NaN are NULL."""
    return finite_number(clean_money_text(text))


def outstanding(assessed: Column, paid: Column) -> Column:
    """What is left to pay on one action; never below zero."""
    return F.greatest(assessed - paid, F.lit(0.0))


def implausible(amount: Column) -> Column:
    """Whether an amount is out of the range of money, so that sums leave it out."""
    return F.coalesce(~(F.abs(amount) < PLAUSIBLE_BELOW), F.lit(False))


def exact_sum(amount: Column) -> Column:
    """Sum of money in whole cents, returned as double; the same for every order of the rows."""
    return exact_cents(amount).cast("double")


def exact_cents(amount: Column) -> Column:
    """Sum of money in whole cents as ``decimal(38,2)``, so that sums can be added up further.

    Cents are summed as two bigints, millions of dollars and the rest, which stay in the hash
    table's fixed-width buffer, several times faster than a decimal sum, and don't overflow for
    fewer than 9e10 rows of a group whatever the amounts. The few amounts too large for exact
    cents are summed beside them as decimals. NULL and implausible amounts add nothing; a group
    with no other is NULL.
    """
    size = F.abs(amount)
    cents = F.floor(F.when(size < _EXACT_CENTS_BELOW, amount) * 100 + 0.5)
    million = F.lit(100_000_000).cast("bigint")
    high = F.sum(F.call_function("div", cents, million)).cast("decimal(20,0)")
    low = F.sum(cents % million).cast("decimal(20,0)")
    beyond = F.when((size >= _EXACT_CENTS_BELOW) & (size < PLAUSIBLE_BELOW), amount).cast("decimal(30,2)")
    exact = high * F.lit(1_000_000).cast("decimal(8,0)") + low / 100
    parts = F.array_compact(F.array(exact.cast("decimal(38,2)"), F.sum(beyond).cast("decimal(38,2)")))
    total = F.aggregate(parts, F.lit(0).cast("decimal(38,2)"), lambda a, b: (a + b).cast("decimal(38,2)"))
    return F.when(F.size(parts) > 0, total)


def exact_total(subtotal: Column) -> Column:
    """Sum of sub-totals that are already few; decimals of 38 digits, so a grand total has room."""
    return F.sum(F.when(F.abs(subtotal) < 1e35, subtotal).cast("decimal(38,2)")).cast("double")
