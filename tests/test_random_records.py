"""Randomised cross-check: Spark operators vs the SQL oracle on random records."""

from __future__ import annotations

import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vulnsift import oracle
from vulnsift.config import SECURITY_KEYWORDS
from vulnsift.functions.dates import with_parsed_date
from vulnsift.operators import scoring
from vulnsift.plans.filter import classify
from vulnsift.schemas import RECORD_SCHEMA

WORDS = list(SECURITY_KEYWORDS) + ["Resource", "SQL injection", "vulnerabilities", "** RESERVED **", "** REJECT **",
                                   "lorem", "ipsum", "Ü", "é", " ", " ", "\t", "\n", " "]
DAYS = ("2024-08-01", "2024-08-02", "2023-02-28", "2024-12-31")
DATES = [None, "", "n/a", "99", "0000", "20231", "2024-123", "2024-8-5T10:00:00", " 2024-08-15 "] + [
    form.format(d=d, y=d[:4], m=d[:7]) for d in DAYS
    for form in ("{d}", "{y}", "{m}", "{d}T10:15:07.123", "{d}T10:15:07Z", "{d} 10:00", "{y}-13-01", "{y}-02-30", "{y}garbage", "{m}-xx", "{d}T25:00:00")
]
LENGTHS = [0, 1, 49, 50, 51, 99, 100, 101, 999, 1000, 1001, 1999, 2000, 2001, 4999, 5000, 5001, 5200]


def _text(rng: random.Random) -> str | None:
    r = rng.random()
    if r < 0.05:
        return None
    if r < 0.1:
        return rng.choice(["", " " * 60, "　 " * 40, "​" * 60])
    n = rng.choice(LENGTHS)
    out = ""
    while len(out) < n:
        out += rng.choice(WORDS) + rng.choice([" ", "", ", "])
    return out[:n]


def _record(rng: random.Random, i: int) -> dict:
    cvss = rng.choice([None, 0.0, 3.9, 4.0, 6.9, 7.0, 9.8, 10.0, float("nan"), round(rng.uniform(0, 10), 1)])
    return {
        "ord": i,
        "cve_id": f"CVE-2024-{i:05d}",
        "description": _text(rng),
        "published": rng.choice(DATES),
        "last_modified": "",
        "cvss_score": cvss,
        "severity": rng.choice([None, "", "LOW", "medium", "High", "CRITICAL", "NONE", "unknown"]),
        "cwe_ids": rng.choice([[], ["CWE-79"]]),
        "source": rng.choice(["nvd", "NVD", "huggingface", "scraper", None, ""]),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_records_agree_with_sql(spark, seed):
    rng = random.Random(seed)
    rows = [_record(rng, i) for i in range(400)]
    df = spark.createDataFrame(rows, RECORD_SCHEMA)
    got = with_parsed_date(classify(scoring.compute_composite(df)), "published", "pub")
    got = {r["ord"]: r for r in got.select(
        "ord", "relevance_score", "completeness_score", "source_credibility_score", "clarity_score",
        "composite_score", "training_ready", "exclusion_reason", "tier", F.col("pub").cast("string").alias("pub")
    ).collect()}

    # Arrow keeps NaN as NaN (a pandas frame would turn it into NULL).
    table = pa.Table.from_pylist([{**{k: v for k, v in r.items() if k != "cwe_ids"},
                                   "cwe_id": r["cwe_ids"][0] if r["cwe_ids"] else None} for r in rows])
    con = duckdb.connect()
    con.register("recs", table)
    sql = (
        f"WITH {oracle.dims_cte('recs')}, {oracle.scored_cte()}, "
        f"ready AS (SELECT * EXCLUDE (ready_raw), ready_raw AS training_ready FROM scored_flag), "
        + oracle.filter_ctes().split("), grp AS (")[0]
        + f") SELECT ord, relevance_score, completeness_score, source_credibility_score, clarity_score, "
        f"composite_score, training_ready, exclusion_reason, tier, "
        f"CAST({oracle.date_sql('published')} AS VARCHAR) AS pub FROM tiered"
    )
    want = {r[0]: r for r in con.sql(sql).fetchall()}
    assert set(got) == set(want)
    cols = ["relevance_score", "completeness_score", "source_credibility_score", "clarity_score",
            "composite_score", "training_ready", "exclusion_reason", "tier", "pub"]
    for o, w in want.items():
        g = got[o]
        for j, c in enumerate(cols, start=1):
            a, b = g[c], w[j]
            if isinstance(a, float) or isinstance(b, float):
                assert (a is None and b is None) or math.isclose(a, b, abs_tol=1e-9), (o, c, a, b, rows[o])
            else:
                assert a == b, (o, c, a, b, rows[o])
