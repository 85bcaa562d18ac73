"""Lenient publication-date parsing: every format branch and edge case."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vulnsift.functions.dates import parse_published, with_parsed_date

CASES = [
    ("", None),
    ("2023-06-15", "2023-06-15"),
    ("2024", "2024-01-01"),
    ("2024-08", "2024-08-01"),
    ("2024-08-15T10:15:07.123", "2024-08-15"),
    ("2024-08-15T10:15:07Z", "2024-08-15"),
    ("2024-08-15 10:00", "2024-08-15"),
    ("2024-13-01", "2024-01-01"),
    ("2024-02-30", "2024-02-01"),
    ("20240815", "2024-01-01"),
    ("2024-8-5", "2024-08-05"),
    ("2024-8-5T10:00:00", "2024-08-05"),
    ("99", None),
    ("0000", None),
    ("n/a", None),
    ("20231", "2023-01-01"),
    ("2024garbage", "2024-01-01"),
    ("2024-08-xx", "2024-08-01"),
    (" 2024-08-15 ", "2024-08-15"),
    ("2024-08-15T25:00:00", "2024-08-15"),
    ("2024-123", "2024-12-01"),
    # further branches
    ("2024-08-15t10:15:07", "2024-08-15"),  # separator in either case
    ("2024-8-5T1:2:3.123456", "2024-08-05"),  # one-digit time fields, six fraction digits
    ("2024-8-5T10:00:60", "2024-01-01"),  # second 60 is no valid time
    ("2024-08- 5", "2024-08-05"),  # space-padded day
    ("2024-02-29", "2024-02-29"),
    ("2023-02-29", "2023-02-01"),
    (" 2024-07-31　", "2024-07-31"),  # Unicode whitespace is stripped
    ("2024-06-30T12:00:00.1234567", "2024-06-30"),  # fraction cut by the prefix length
    (None, None),
]


@pytest.mark.parametrize("use_staged", [True, False])
def test_parse_cases(spark, use_staged):
    rows = [(i, s) for i, (s, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "ord long, published string")
    if use_staged:
        out = with_parsed_date(df, "published", "d")
    else:
        out = df.withColumn("d", parse_published(F.col("published")))
    got = {r["ord"]: r["d"] for r in out.collect()}
    for i, (s, expected) in enumerate(CASES):
        want = dt.date.fromisoformat(expected) if expected else None
        assert got[i] == want, (s, got[i], want)
