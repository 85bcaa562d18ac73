"""String column helpers (JVM-side built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as Python's str.strip()/str.isspace() define it (ASCII
# control separators, NEL, NBSP, the Zs block, line/paragraph separators).
# Spark's trim() removes only spaces, so blankness and stripping use this class.
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANK_PATTERN = "^" + WHITESPACE_CLASS + "*$"
EDGE_WHITESPACE_PATTERN = "^" + WHITESPACE_CLASS + "+|" + WHITESPACE_CLASS + "+$"


def text_or_empty(col: Column) -> Column:
    """A missing text counts as the empty string."""
    return F.coalesce(col, F.lit(""))


def is_blank(col: Column) -> Column:
    """True when the text is null, empty or only Unicode whitespace."""
    return text_or_empty(col).rlike(BLANK_PATTERN)


def strip_unicode(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(col, EDGE_WHITESPACE_PATTERN, "")


def has_text(col: Column) -> Column:
    """True when the text is neither null nor empty (Python truthiness)."""
    return text_or_empty(col) != F.lit("")


def has_items(col: Column) -> Column:
    """True when the array is neither null nor empty."""
    return F.coalesce(F.size(col), F.lit(0)) > F.lit(0)


def count_substrings_present(lowered: Column, needles: tuple[str, ...]) -> Column:
    """Number of needles that occur (as plain substrings) in ``lowered``."""
    hits = [F.when(F.contains(lowered, F.lit(n)), F.lit(1)).otherwise(F.lit(0)) for n in needles]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def contains_any(col: Column, needles: tuple[str, ...]) -> Column:
    """True when any needle occurs literally (case-sensitive) in the text."""
    cond = F.contains(col, F.lit(needles[0]))
    for n in needles[1:]:
        cond = cond | F.contains(col, F.lit(n))
    return cond
