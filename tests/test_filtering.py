"""Exclusions, tiers, sampling, decontamination and the filter run."""

from __future__ import annotations

import itertools

import pytest

from conftest import scored_row
from vulnsift import config as K
from vulnsift.config import CurationConfig
from vulnsift.operators import filtering
from vulnsift.plans.filter import filter_summary, read_route, run_filter_pipeline

ROUTES = (K.ROUTE_REJECTED, K.ROUTE_REVIEW, K.ROUTE_FINAL, K.ROUTE_FLAGGED)


# exclusions -------------------------------------------------------------------
def test_exclusion_reasons_of_every_combination(scored):
    parts = [(dict(clarity_score=0.0), K.REASON_CLARITY), (dict(description=" \t　 "), K.REASON_BLANK),
             (dict(source_credibility_score=0.29), K.REASON_UNTRUSTED)]
    cases = [c for n in range(4) for c in itertools.combinations(parts, n)]
    rows = [scored_row(**{k: v for change, _ in case for k, v in change.items()}) for case in cases]
    df = scored(rows)
    kept, excluded = filtering.apply_hard_exclusions(df)
    got = {r["ord"]: r["exclusion_reason"] for r in excluded.collect()}
    assert got == {i: "; ".join(reason for _, reason in case) for i, case in enumerate(cases) if case}
    assert [r["ord"] for r in kept.collect()] == [0] and kept.columns == df.columns


def test_missing_scores_never_exclude(scored):
    rows = [scored_row(clarity_score=None), scored_row(source_credibility_score=None), scored_row(source_credibility_score=0.3),
            scored_row(description=None), scored_row(description="​" * 9)]  # a zero-width space is not blank
    kept, _ = filtering.apply_hard_exclusions(scored(rows))
    assert sorted(r["ord"] for r in kept.collect()) == [0, 1, 2, 4]


# tiers ------------------------------------------------------------------------
def test_tier_bounds(scored):
    cases = [(0.60, K.TIER_READY), (0.5999, K.TIER_REVIEW), (0.40, K.TIER_REVIEW), (0.3999, K.TIER_REJECTED), (1.0, K.TIER_READY),
             (None, K.TIER_REJECTED), (float("nan"), K.TIER_REJECTED)]
    got = filtering.apply_tiered_filter(scored([scored_row(composite_score=c) for c, _ in cases])).orderBy("ord").collect()
    assert [r["tier"] for r in got] == [t for _, t in cases]


# sample -----------------------------------------------------------------------
def plain_sample(rows: list[dict], k: int) -> list[tuple]:
    """(group, rank, position) of the sample, by sorting each group."""
    groups: dict[str, list] = {}
    for i, r in enumerate(rows):
        groups.setdefault((r["severity"] or "UNKNOWN").upper(), []).append((-(r["composite_score"] or 0), i))
    return sorted((g, n + 1, i) for g, name in enumerate(K.SEVERITY_ORDER) for n, (_, i) in enumerate(sorted(groups.get(name, []))[:k]))


@pytest.mark.parametrize("k", [0, 1, 7, 500])
@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_sample_equals_a_sort_of_each_group(scored, k, buckets):
    labels = ("CRITICAL", "critical", "HIGH", "", None, "NONE", "Low", "unknown")
    rows = [scored_row(severity=labels[i * i % 8], composite_score=None if i % 29 == 0 else (i * 37 % 11) / 10) for i in range(240)]
    out = filtering.apply_stratified_sample(scored(rows), target_per_severity=k, buckets=buckets).collect()
    assert sorted((r["severity_rank"], r["sample_rank"], r["ord"]) for r in out) == plain_sample(rows, k)
    assert all(r["sampled"] for r in out) and {r["severity"] for r in out} <= set(labels)


def test_sample_loses_nothing_without_positions(scored):
    from pyspark.sql import functions as F

    rows = [scored_row(cve_id=f"CVE-2001-{i:04d}") for i in range(5)]
    df = scored(rows).withColumn("ord", F.lit(None).cast("long"))
    assert filtering.apply_stratified_sample(df).count() == 5
    s = filter_summary(df).first()
    assert (s["training_ready_raw"], s["sampled"], s["training_final"]) == (5, 5, 5)
    same = scored(rows).withColumn("ord", F.lit(3).cast("long"))
    assert filtering.apply_stratified_sample(same, target_per_severity=3).count() == 3


# decontamination --------------------------------------------------------------
@pytest.mark.parametrize("published,after", [
    ("2019-07-01", False), ("2019-07-02", True), ("2019-07-02T23:59:59.999", True), ("2019", False), ("2020", True), ("2019-07", False),
    ("2019-08", True), ("", False), (None, False), ("soon", False),
])
def test_decontamination(scored, published, after):
    clean, flagged = filtering.apply_decontamination(scored([scored_row(published=published)]), cutoff_date="2019-07-01")
    assert (clean.count(), flagged.count()) == (int(not after), int(after))
    if after:
        assert flagged.first()["contamination_flag"] is True


# filter run -------------------------------------------------------------------
def mixed(n: int) -> list[dict]:
    """Records by rule over all routes."""
    labels = ("HIGH", "LOW", "NONE", None)
    return [
        scored_row(cve_id=f"CVE-2005-{i:04d}", severity=labels[i % 4], composite_score=(i * 13 % 100) / 100,
                   clarity_score=0.0 if i % 9 == 4 else 0.75, published=("2030-01-01", "2004")[i % 2])
        for i in range(n)
    ]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_run_routes_every_record_once(spark, scored, tmp_path, fmt):
    rows, cfg, out = mixed(120), CurationConfig(per_severity_quota=6), str(tmp_path / "out")
    run = run_filter_pipeline(scored(rows), out, cfg, fmt)
    assert filter_summary(scored(rows), cfg).first().asDict() == run.summary
    got = {route: read_route(spark, out, route, fmt=fmt).collect() for route in ROUTES}
    s = run.summary
    assert [len(got[r]) for r in ROUTES] == [s["hard_excluded"], s["review_queue"], s["training_final"], s["flagged_contamination"]]
    ids = [r["cve_id"] for rows_ in got.values() for r in rows_]
    assert len(ids) == len(set(ids)) and s["total_input"] == 120
    assert all(r["exclusion_reason"] for r in got[K.ROUTE_REJECTED]) and all(r["tier"] == K.TIER_REVIEW for r in got[K.ROUTE_REVIEW])
    assert all(r["contamination_flag"] is True for r in got[K.ROUTE_FLAGGED]) and all(r["contamination_flag"] is None for r in got[K.ROUTE_FINAL])
    order = [(r["severity_rank"], r["sample_rank"]) for r in got[K.ROUTE_FINAL]]
    assert order == sorted(order)


@pytest.mark.parametrize("rows", [
    [],  # nothing at all
    [scored_row(cve_id=f"CVE-2007-{i:04d}", composite_score=0.9) for i in range(4)],  # only clean, ready records
    [scored_row(clarity_score=0.0)],  # only rejected ones
])
def test_all_four_routes_exist(spark, scored, tmp_path, rows):
    out = str(tmp_path / "out")
    run_filter_pipeline(scored(mixed(60)), out)
    run = run_filter_pipeline(scored(rows), out)  # replaces what the first run wrote
    counts = {route: read_route(spark, out, route).count() for route in ROUTES}
    assert sum(counts.values()) == len(rows) == run.summary["total_input"]
    assert counts[K.ROUTE_FINAL] == run.summary["training_final"] and counts[K.ROUTE_REJECTED] == run.summary["hard_excluded"]


def test_zero_threshold_keeps_missing_composite(scored):
    cfg = CurationConfig(quality_threshold=0.0, review_floor=0.0)
    s = filter_summary(scored([scored_row(composite_score=None), scored_row(composite_score=0.5)]), cfg).first()
    assert s["training_ready_raw"] == 2 and s["sampled"] == 2
