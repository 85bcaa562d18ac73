"""Primary-page and mirror-row normalisation; merge, precedence, dedup and caps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vulnsift.operators import merge, normalise
from vulnsift.plans.ingest import ingest_frames, merge_sources
from vulnsift.schemas import MIRROR_SCHEMA, NVD_PAGE_SCHEMA


def _cvss(score, sev):
    return {"cvssData": {"baseScore": score, "baseSeverity": sev}}


def _page(start, items):
    return {"startIndex": start, "totalResults": 1000, "vulnerabilities": [{"cve": c} for c in items]}


def test_primary_page_fields(spark):
    items = [
        {
            "id": "CVE-2024-0001",
            "published": "2024-03-01T10:00:00.000",
            "lastModified": "2024-03-02",
            "metrics": {"cvssMetricV31": [], "cvssMetricV30": [_cvss(6.5, "MEDIUM"), _cvss(9.9, "CRITICAL")]},
            "descriptions": [{"lang": "es", "value": "Descripción"}, {"lang": "EN-us", "value": "English text"}],
            "weaknesses": [{"description": [{"value": "CWE-1"}, {"value": "NVD-CWE-Other"}]},
                           {"description": [{"value": "CWE-79"}, {"value": "CWE-1"}]}],
        },
        {"id": "CVE-2024-0002"},
        {
            "id": "CVE-2024-0003",
            "metrics": {"cvssMetricV31": [{"cvssData": None}], "cvssMetricV30": [_cvss(5.0, "MEDIUM")]},
            "descriptions": [{"lang": "fr", "value": "Texte"}],
        },
        {
            "id": "CVE-2024-0004",
            "metrics": {"cvssMetricV31": [_cvss(7.5, "HIGH")], "cvssMetricV30": [_cvss(1.0, "LOW")]},
            "descriptions": [{"lang": "en", "value": None}],
        },
    ]
    pages = spark.createDataFrame([_page(200, items)], NVD_PAGE_SCHEMA)
    out = {r["cve_id"]: r for r in normalise.normalise_primary_pages(pages).collect()}
    a = out["CVE-2024-0001"]
    assert (a["ord"], a["cvss_score"], a["severity"]) == (200, 6.5, "MEDIUM")
    assert a["description"] == "English text" and a["cwe_ids"] == ["CWE-1", "CWE-79", "CWE-1"]
    assert a["published"] == "2024-03-01T10:00:00.000" and a["last_modified"] == "2024-03-02"
    assert a["source"] == "nvd"
    b = out["CVE-2024-0002"]
    assert (b["ord"], b["cvss_score"], b["severity"], b["description"], b["cwe_ids"], b["published"]) == (
        201, None, None, "", [], "")
    c = out["CVE-2024-0003"]  # first V3.1 entry without data: no fall-through
    assert (c["cvss_score"], c["severity"], c["description"]) == (None, None, "")
    d = out["CVE-2024-0004"]
    assert (d["cvss_score"], d["severity"], d["description"]) == (7.5, "HIGH", "")


def test_primary_pages_read_from_json(spark, tmp_path):
    import json

    path = tmp_path / "pages"
    path.mkdir()
    for start in (0, 2):
        items = [{"id": f"CVE-2024-{start + i}", "descriptions": [{"lang": "en", "value": "x"}]} for i in range(2)]
        (path / f"page_{start}.json").write_text(json.dumps(_page(start, items), indent=2))
    from vulnsift.sources.landing import read_primary_pages

    out = normalise.normalise_primary_pages(read_primary_pages(spark, str(path)))
    assert sorted((r["ord"], r["cve_id"]) for r in out.collect()) == [
        (0, "CVE-2024-0"), (1, "CVE-2024-1"), (2, "CVE-2024-2"), (3, "CVE-2024-3")]


def _mirror(spark, rows):
    full = [dict({c: None for c in MIRROR_SCHEMA.fieldNames()}, ord=i, **r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, MIRROR_SCHEMA)


@pytest.mark.parametrize(
    "v3,v4,v2,expected",
    [("7.5", None, None, 7.5), ("", "8.1", None, 8.1), (None, None, "5", 5.0), ("", "", "", None),
     ("abc", "9", "9", None), ("0", "9", None, 0.0), (None, None, " 4.3 ", 4.3), ("inf", None, None, None),
     ("1_0", None, None, None), ("7.5d", None, None, None), (".5", None, None, 0.5), ("1e1", None, None, 10.0)],
)
def test_mirror_cvss(spark, v3, v4, v2, expected):
    df = _mirror(spark, [{"CVE-ID": "CVE-2020-1", "CVSS-V3": v3, "CVSS-V4": v4, "CVSS-V2": v2}])
    assert normalise.normalise_mirror_rows(df).first()["cvss_score"] == expected


@pytest.mark.parametrize(
    "cid,year", [("CVE-2023-1", "2023"), ("CVE-99-1", "99"), ("CVE-2023", "2023"), ("CVE-x-1", ""),
                 ("cve-2023-1", ""), ("CVE--1", "")],
)
def test_mirror_year_from_id(spark, cid, year):
    df = _mirror(spark, [{"CVE-ID": cid}])
    assert normalise.normalise_mirror_rows(df).first()["published"] == year


def test_mirror_fields(spark):
    rows = [
        {"CVE-ID": "CVE-2020-1", "DESCRIPTION": None, "SEVERITY": "high", "CWE-ID": "NVD-CWE-Other"},
        {"CVE-ID": "CVE-2020-2", "DESCRIPTION": "d", "SEVERITY": "", "CWE-ID": "Improper Input"},
        {"CVE-ID": "", "DESCRIPTION": "skipped"},
        {"CVE-ID": None, "DESCRIPTION": "skipped"},
        {"CVE-ID": "CVE-2020-3", "SEVERITY": None, "CWE-ID": "NVD-CWE-noinfo"},
        {"CVE-ID": "CVE-2020-4", "CWE-ID": "CWE-89"},
    ]
    out = {r["cve_id"]: r for r in normalise.normalise_mirror_rows(_mirror(spark, rows)).collect()}
    assert sorted(out) == ["CVE-2020-1", "CVE-2020-2", "CVE-2020-3", "CVE-2020-4"]
    assert out["CVE-2020-1"]["description"] == "None" and out["CVE-2020-1"]["severity"] == "HIGH"
    assert out["CVE-2020-1"]["cwe_ids"] == [] and out["CVE-2020-3"]["cwe_ids"] == []
    assert out["CVE-2020-2"]["severity"] is None and out["CVE-2020-2"]["cwe_ids"] == ["Improper Input"]
    assert out["CVE-2020-4"]["cwe_ids"] == ["CWE-89"]
    assert all(r["source"] == "huggingface" and r["last_modified"] == "" for r in out.values())


# merge ------------------------------------------------------------------------
def test_anti_join_and_keep_first(records):
    primary = records([dict(cve_id=c, source="nvd") for c in ("A", "B", "A", "")])
    mirror = records([dict(cve_id=c, source="huggingface") for c in ("B", "C", "C", "")])
    assert sorted(r["cve_id"] for r in merge.drop_known_ids(mirror, primary).collect()) == ["C", "C"]
    merged = merge.keep_first(merge.ordered_union(primary, mirror))
    got = sorted((r["cve_id"], r["source"], r["src_rank"], r["ord"]) for r in merged.collect())
    assert got == [("A", "nvd", 0, 0), ("B", "nvd", 0, 1), ("C", "huggingface", 1, 1)]


def test_merge_equals_anti_join_path(records):
    primary = records([dict(cve_id=f"X{i % 7}", source="nvd") for i in range(20)])
    mirror = records([dict(cve_id=f"X{i % 11}", source="huggingface") for i in range(30)])
    slow = merge.keep_first(merge.ordered_union(primary, merge.drop_known_ids(mirror, primary)))
    key = lambda df: sorted((r["cve_id"], r["src_rank"], r["ord"]) for r in df.collect())
    assert key(merge_sources(primary, mirror)) == key(slow)


@pytest.mark.parametrize("ord_", [None, 4, -(1 << 62)])
def test_keep_first_with_equal_or_missing_positions(records, ord_):
    df = records([dict(cve_id=c, ord=ord_) for c in ("A", "B", "A", "C", "B", "A")])
    assert sorted(r["cve_id"] for r in merge.keep_first(df).collect()) == ["A", "B", "C"]


def test_records_without_a_position_come_last(records):
    df = records([dict(cve_id="A", ord=None, source="x"), dict(cve_id="A", ord=9, source="y")])
    assert merge.keep_first(df).first()["source"] == "y"


def test_keep_first_limits_a_hot_key_before_the_shuffle(records):
    rows = [dict(cve_id="HOT") for _ in range(300)] + [dict(cve_id=f"K{i}") for i in range(150)]
    out = merge.keep_first(records(rows))
    assert out.count() == 151 and out.filter(F.col("cve_id") == "HOT").first()["ord"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") and "Join" not in plan


def test_renumbered_is_dense_enough_and_in_order(records):
    rows = [dict(cve_id=f"K{i}", ord=100 - i) for i in range(50)] + [dict(cve_id="Z", ord=None)]
    got = [r["cve_id"] for r in merge.renumbered(records(rows)).orderBy("ord").collect()]
    assert got == [f"K{i}" for i in range(49, -1, -1)] + ["Z"]


# feeds as they come -------------------------------------------------------------
def page(start, ids, **more):
    return {"startIndex": start, "vulnerabilities": [{"cve": {"id": i}} for i in ids], **more}


def ingested(spark, pages, mirror=()):
    rows = ingest_frames(spark.createDataFrame(pages, NVD_PAGE_SCHEMA), _mirror(spark, list(mirror)))
    return [r["cve_id"] for r in rows.orderBy(*merge.record_order(rows)).collect()]


@pytest.mark.parametrize("pages,want", [
    ([page(0, "AB"), page(0, "AB")], "AB"),  # a page landed twice
    ([page(None, "AB"), page(None, "CA")], "ABC"),  # no positions: as they lie
    ([page(0, "ABC"), page(3, "D", resultsPerPage=3), page(6, "EF")], "ABCDEF"),  # a short page in the middle
    ([page(0, "AB"), page(2, ""), page(4, "C")], "ABC"),  # an empty page
    ([page(0, "AB", totalResults=4), page(2, "CD", totalResults=4), page(4, "EF", totalResults=6)], "ABCDEF"),  # the feed grew
    ([page(4, "C"), page(0, "AB")], "ABC"),  # landed out of order
    ([], ""),
])
def test_every_landed_page_counts(spark, pages, want):
    assert "".join(ingested(spark, pages)) == want


def test_mirror_without_positions(spark):
    rows = spark.createDataFrame([("CVE-2020-1", "d"), ("CVE-2020-2", "e")], "`CVE-ID` string, DESCRIPTION string")
    for c in ("CVSS-V4", "CVSS-V3", "CVSS-V2", "SEVERITY", "CWE-ID"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    empty = spark.createDataFrame([], NVD_PAGE_SCHEMA)
    assert sorted(r["cve_id"] for r in ingest_frames(empty, rows).collect()) == ["CVE-2020-1", "CVE-2020-2"]


@pytest.mark.parametrize("v3,v4,v2,expected", [
    (7.5, 1.0, 1.0, 7.5), (0.0, 8.1, 1.0, 8.1), (None, 0.0, 5.0, 5.0), (None, None, 0.0, 0.0), (None, None, None, None),
])
def test_mirror_number_columns(spark, v3, v4, v2, expected):
    schema = "`CVE-ID` string, DESCRIPTION string, `CVSS-V4` double, `CVSS-V3` double, `CVSS-V2` float, SEVERITY string, `CWE-ID` string"
    df = spark.createDataFrame([("CVE-2020-1", "d", v4, v3, v2, "LOW", None)], schema)
    assert normalise.normalise_mirror_rows(df).first()["cvss_score"] == expected
