"""Calendar dates from text in mixed formats."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The accepted forms (month/day/year, year-month-day; one-digit parts allowed) and
# the first day an action may plausibly carry. Space separators are trimmed first, then the
# blanks, tabs and line breaks that date reading skips at both ends.
_LEAD, _TAIL = r"\p{Zs}*\s*", r"\s*\p{Zs}*"
_SLASH_FORM = r"(\d{1,2})/(\d{1,2})/(\d{%s})"
_DASH_FORM = r"(\d{1,4})-(\d{1,2})-(\d{1,2})"
ACTION_DATE_FLOOR = date(1900, 1, 1)

# With two-digit years 00 to 68 mean 20xx and 69 to 99 mean 19xx.
_PIVOT_STEPS = (
    (rf"/(\d)(?={_TAIL}\z)", "/200$1"),
    (rf"/([0-5]\d|6[0-8])(?={_TAIL}\z)", "/20$1"),
    (rf"/(69|[7-9]\d)(?={_TAIL}\z)", "/19$1"),
)


def floor_date(day: Column, floor: date = ACTION_DATE_FLOOR) -> Column:
    """NULL for days before the floor."""
    return F.when(day >= F.lit(floor), day)


def parse_date(text: Column, floor: date | None = None, two_digit_year: str = "literal") -> Column:
    """Text to date by the first matching form; impossible days and anything else are NULL.

    ``two_digit_year="literal"`` reads ``12/29/16`` as year 16, which a floor then turns into
    NULL; ``"pivot"`` reads it as 2016 (and ``69`` as 1969).

    One substitution puts either form in year-month-day order and empties every other text; the
    cast that follows wants at least four year digits and, unlike pattern parsing, builds no
    exception for a miss. The text is mentioned once, so a filter on the date that is pushed
    below this projection stays small too.
    """
    if two_digit_year == "literal":
        year_digits = "1,4"
    elif two_digit_year == "pivot":
        year_digits = "4"
        for pattern, replacement in _PIVOT_STEPS:
            text = F.regexp_replace(text, pattern, replacement)
    else:
        raise ValueError(f"two_digit_year must be 'literal' or 'pivot', not {two_digit_year!r}")
    either = rf"(?s)\A(?:{_LEAD}(?:{_SLASH_FORM % year_digits}|{_DASH_FORM}){_TAIL}|.*)\z"
    day = F.regexp_replace(text, either, "000$3$4-$1$5-$2$6").try_cast("date")
    return day if floor is None else floor_date(day, floor)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def calendar_year(day: Column) -> Column:
    return F.year(day)


def years_before(day: Column, years: int) -> Column:
    """Same calendar day some years earlier; 29 February clamps to the 28th."""
    return F.add_months(day, -12 * years)
