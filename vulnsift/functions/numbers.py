"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnsift.functions.text import strip_unicode

# A plain decimal number: optional sign, digits with an optional fraction (or a
# bare fraction), optional exponent. Anything else (``inf``, ``nan``, ``1_0``,
# ``7.5d``) is not a score.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_plain_number(text: Column) -> Column:
    """Text → DOUBLE for plain decimal numbers (surrounding whitespace allowed), else null."""
    stripped = strip_unicode(text)
    return F.when(stripped.rlike(PLAIN_NUMBER), stripped.try_cast("double"))


def is_real(col: Column) -> Column:
    """Present and not NaN (NaN compares as the largest double in Spark)."""
    return col.isNotNull() & ~F.isnan(col)


def round_stat(col: Column, digits: int = 6) -> Column:
    """Round an aggregate so that engines summing in different orders agree."""
    return F.round(col.cast("double"), digits)


def pct(part: Column, whole: Column) -> Column:
    """part / whole × 100, 0 for an empty input."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))
