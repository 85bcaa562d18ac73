"""Lenient publication-date parsing as a pure column expression.

Formats are tried in this order, each on a prefix of the stripped input whose
length is the format's length plus two, itself stripped again:

    %Y-%m-%dT%H:%M:%S.%f   prefix 22
    %Y-%m-%dT%H:%M:%S      prefix 19
    %Y-%m-%d               prefix 10
    %Y-%m                  prefix 7
    %Y                     prefix 4

The whole prefix must match the format (the separator ``T`` in either case,
one- or two-digit month/day/time fields, a space-padded day, 1–6 fraction
digits) and name a real calendar day; the first format that does wins. Year
0000 never parses. Anything else is null. Only the date part is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift.functions import per_session
from vulnsift.functions.text import strip_unicode

_YEAR = "([0-9]{4})"
_MONTH = "(1[0-2]|0[1-9]|[1-9])"
_DAY = "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_HOUR = "(?:2[0-3]|[01][0-9]|[0-9])"
_MINUTE = "(?:[0-5][0-9]|[0-9])"
_SECOND = "(?:[0-5][0-9]|[0-9])"  # 60 and 61 match the format but are not valid times
_FRACTION = "(?:[0-9]{1,6})"
_TIME = "[Tt]" + _HOUR + ":" + _MINUTE + ":" + _SECOND

# (prefix length, anchored pattern, has month group, has day group)
DATE_FORMATS: tuple[tuple[int, str, bool, bool], ...] = (
    (22, "^" + _YEAR + "-" + _MONTH + "-" + _DAY + _TIME + r"\." + _FRACTION + "$", True, True),
    (19, "^" + _YEAR + "-" + _MONTH + "-" + _DAY + _TIME + "$", True, True),
    (10, "^" + _YEAR + "-" + _MONTH + "-" + _DAY + "$", True, True),
    (7, "^" + _YEAR + "-" + _MONTH + "$", True, False),
    (4, "^" + _YEAR + "$", False, False),
)


def _candidate(piece: Column, pattern: str, has_month: bool, has_day: bool) -> Column:
    matched = piece.rlike(pattern)
    year = F.regexp_extract(piece, pattern, 1)
    month = F.lpad(F.regexp_extract(piece, pattern, 2), 2, "0") if has_month else F.lit("01")
    day = F.lpad(F.trim(F.regexp_extract(piece, pattern, 3)), 2, "0") if has_day else F.lit("01")
    iso = F.concat_ws("-", year, month, day)
    return F.when(matched & (year != F.lit("0000")), iso.try_cast("date"))


def _prefix(stripped: Column, length: int) -> Column:
    return strip_unicode(F.substring(stripped, 1, length))


def parse_published(col: Column) -> Column:
    """Parse a free-form publication text into a DATE (null when unparseable).

    A single expression; for wide projections prefer ``with_parsed_date``,
    which stages the work so generated code stays small.
    """
    stripped = strip_unicode(F.coalesce(col.cast("string"), F.lit("")))
    return F.coalesce(*[_candidate(_prefix(stripped, n), p, m, d) for n, p, m, d in DATE_FORMATS])


def with_parsed_date(df: DataFrame, source: str = "published", target: str = "published_date") -> DataFrame:
    """Add ``target`` = parsed date of ``source``, computed in staged projections.

    The stripped text and each stripped prefix are projected once (they are
    referenced several times, so Catalyst keeps them as separate projections)
    and the five candidates then only read those columns.
    """
    base = "_pd_text"
    pieces = _prefix_columns(base)
    staged = df.withColumn(base, _stripped_text(source))
    staged = staged.withColumns(pieces)
    return staged.withColumn(target, _parsed_from_prefixes()).drop(base, *pieces)


@per_session
def _stripped_text(source: str) -> Column:
    return strip_unicode(F.coalesce(F.col(source).cast("string"), F.lit("")))


def _prefix_columns(base: str) -> dict[str, Column]:
    return {f"_pd_{n}": _prefix_of(base, n) for n, _, _, _ in DATE_FORMATS}


@per_session
def _prefix_of(base: str, n: int) -> Column:
    return _prefix(F.col(base), n)


@per_session
def _parsed_from_prefixes() -> Column:
    return F.coalesce(*[_candidate(F.col(f"_pd_{n}"), p, m, d) for n, p, m, d in DATE_FORMATS])
