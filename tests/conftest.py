"""Shared fixtures: one local session for the whole test run."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from vulnsift.schemas import RECORD_SCHEMA, SCORED_SCHEMA  # noqa: E402
from vulnsift.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

FILLER = "lorem ipsum dolor sit amet "


def text_of(length: int, prefix: str = "") -> str:
    """A text of exactly ``length`` code points that starts with ``prefix``
    and adds no security keyword."""
    body = prefix
    while len(body) < length:
        body += FILLER
    return body[:length]


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=8, app="vulnsift-tests")
    yield session
    session.stop()


def _rows(rows: list[dict], schema) -> list[dict]:
    out = []
    for i, r in enumerate(rows):
        full = {f.name: None for f in schema.fields}
        full["ord"] = i
        full.update(r)
        out.append(full)
    return out


@pytest.fixture
def records(spark):
    """Build a record frame from dicts (missing fields null, ``ord`` = list position)."""

    def make(rows: list[dict]):
        return spark.createDataFrame(_rows(rows, RECORD_SCHEMA), RECORD_SCHEMA)

    return make


def scored_row(**overrides) -> dict:
    """A scored record that no exclusion takes and that is ready, its scores in
    steps of an eighth; everything that a test is about it sets itself."""
    eighths = dict(relevance_score=5, completeness_score=7, source_credibility_score=8, clarity_score=6, composite_score=6)
    base = {name: n / 8 for name, n in eighths.items()}
    base |= dict(cve_id="CVE-2011-70001", description=text_of(333, "Heap reuse in a parser. "), published="2011-11-11", last_modified="2012-12-12")
    base |= dict(cvss_score=5.2, severity="MEDIUM", cwe_ids=["CWE-416", "CWE-20"], source="nvd", training_ready=True)
    base |= dict(pipeline_version="test", scored_at="2030-05-05T05:05:05Z")
    return base | overrides


@pytest.fixture
def scored(spark):
    """Build a scored frame from dicts (see ``scored_row``)."""

    def make(rows: list[dict]):
        return spark.createDataFrame(_rows(rows, SCORED_SCHEMA), SCORED_SCHEMA)

    return make
