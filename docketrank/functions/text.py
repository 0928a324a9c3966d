"""Text cleaning: Column in, Column out, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Unicode space separators (category Zs), which trimming removes.
# Tabs and line breaks are not in the category and stay.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)


def trim_text(text: Column) -> Column:
    """Strip space separators, the no-break space included, from both ends.

    Spark's own ``trim`` knows U+0020 only but is much faster than its trim by a character
    set, so pure ASCII values (as many bytes as characters) take the fast one.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.trim(text)).otherwise(F.trim(text, F.lit(SPACE_SEPARATORS)))


def normalize_key(text: Column) -> Column:
    """The form in which keys of different sources are compared: trimmed, upper case."""
    return F.upper(trim_text(text))


def is_nonblank(text: Column) -> Column:
    """True when something is left after trimming; NULL and blank both fail as a filter."""
    return trim_text(text) != ""
