"""Report tables against hand-checked values and Python's statistics module."""

from __future__ import annotations

import random
import statistics

import pytest

from conftest import scored_row
from vulnsift.operators import report, summaries
from vulnsift.plans.report import generate_report, load_scored
from vulnsift.sources.jsonl import EmptyInputError, write_jsonl


def _hinges(values):
    s = sorted(values)
    n = len(s)
    if n < 2:
        return None, None, None
    q1 = statistics.median(s[: n // 2])
    q3 = statistics.median(s[(n + 1) // 2:])
    return q1, q3, q3 - q1


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9, 50, 51])
def test_credibility_hinges(scored, n):
    rng = random.Random(n)
    values = [rng.choice([0.0, 0.3, 0.4, 0.6, 0.7, 1.0]) for _ in range(n)]
    rows = [scored_row(source_credibility_score=v) for v in values]
    got = report.credibility_hinges(scored(rows)).first()
    want = _hinges(values)
    for g, w in zip((got["q1"], got["q3"], got["iqr"]), want):
        assert (g is None) == (w is None)
        if w is not None:
            assert g == pytest.approx(w)


@pytest.mark.parametrize("n", [1, 2, 5, 6])
def test_median(scored, n):
    values = [round(0.005 * (7 * i % 200), 4) for i in range(n)]
    got = report.median_score(scored([scored_row(composite_score=v) for v in values])).first()[0]
    assert got == pytest.approx(statistics.median(values))


def test_missing_composite_counts_as_zero(scored):
    rows = [scored_row(composite_score=None, training_ready=None), scored_row(composite_score=0.8)]
    head = report.headline_stats(scored(rows)).first()
    assert head["avg_composite"] == pytest.approx(0.4) and head["ready_count"] == 1
    summ = summaries.score_summary(scored(rows)).first()
    assert summ["avg_composite"] == pytest.approx(0.8)  # stage summary averages present values only


def test_histogram_bins(scored):
    values = [0.0, 0.049, 0.05, 0.6, 0.6, 0.65, 0.9999, 1.0]
    out = {r["bin"]: r for r in report.score_histogram(scored([scored_row(composite_score=v) for v in values])).collect()}
    assert len(out) == 21
    counts = {b: r["count"] for b, r in out.items() if r["count"]}
    assert counts == {0: 2, 1: 1, 12: 2, 13: 1, 19: 1, 20: 1}
    assert (out[12]["bin_start"], out[12]["bin_end"]) == (0.6, 0.65)


def test_modal_severity_tie_goes_to_first_seen(scored):
    sevs = ["LOW", "high", "HIGH", "LOW", None, ""]
    out = report.modal_severity(scored([scored_row(severity=s) for s in sevs])).first()
    assert (out["top_severity"], out["top_severity_count"]) == ("LOW", 2)
    sevs = ["high", "LOW", "HIGH", "LOW"]
    assert report.modal_severity(scored([scored_row(severity=s) for s in sevs])).first()["top_severity"] == "HIGH"


def test_severity_distribution_buckets(scored):
    sevs = ["CRITICAL", "high", "NONE", None, "", "medium", "weird"]
    out = {r["severity"]: r["count"] for r in report.severity_distribution(scored([scored_row(severity=s) for s in sevs])).collect()}
    assert out == {"CRITICAL": 1, "HIGH": 1, "MEDIUM": 1, "LOW": 0, "UNKNOWN": 4}


def test_readiness_breakdown_over_all_rows(scored):
    values = [0.6, 0.5999, 0.4, 0.3999, 0.0]
    out = {r["bucket"]: (r["count"], r["pct"]) for r in report.readiness_breakdown(scored([scored_row(composite_score=v) for v in values])).collect()}
    assert out == {"Training Ready": (1, 20.0), "Review Queue": (2, 40.0), "Rejected": (2, 40.0)}


def test_top20_table_and_stats(scored):
    rows = [scored_row(cve_id=f"C{i}", composite_score=round(0.5 + (i % 10) * 0.05, 4), source="nvd" if i % 2 else "hf",
                       cvss_score=None if i == 9 else 7.0, severity="" if i == 19 else "HIGH",
                       training_ready=(i % 10) * 0.05 + 0.5 >= 0.6) for i in range(30)]
    df = scored(rows)
    table = report.top20_table(df).orderBy("rank").collect()
    assert len(table) == 20 and table[0]["cve_id"] == "C9" and table[0]["cvss"] == "—"
    assert table[0]["composite"] == "0.950" and table[0]["training_ready"] == "Yes"
    assert [r["cve_id"] for r in table[:3]] == ["C9", "C19", "C29"]  # ties: earlier ord first
    assert table[1]["severity"] == "—" and table[3]["cvss"] == "7.000"
    stats = report.top20_stats(df).first()
    assert stats["top20_nvd_pct"] == pytest.approx(100.0 * sum(1 for r in table if int(r["cve_id"][1:]) % 2) / 20)
    heat = report.heatmap(df).collect()
    assert len(heat) == 4 * 30 and {r["dimension"] for r in heat} == {
        "relevance_score", "completeness_score", "source_credibility_score", "clarity_score"}


def test_dimension_summary_quartiles(scored):
    values = [0.0, 0.3, 0.5, 0.7, 1.0]
    out = {r["dimension"]: r for r in report.dimension_summary(scored([scored_row(relevance_score=v) for v in values])).collect()}
    r = out["relevance_score"]
    assert (r["min"], r["q1"], r["median"], r["q3"], r["max"]) == (0.0, 0.3, 0.5, 0.7, 1.0)
    assert r["mean"] == pytest.approx(0.5)


def test_callout_facts_median_on_threshold_is_above(scored):
    rows = [scored_row(composite_score=v) for v in (0.5, 0.6, 0.7)]
    out = report.callout_facts(scored(rows)).first()
    assert out["median_score"] == 0.6 and out["median_position"] == "above"


def test_generate_report_guards_and_tables(spark, scored, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_scored(spark, str(tmp_path / "missing"))
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "part-0.json").write_text("\n\n")
    with pytest.raises(EmptyInputError):
        load_scored(spark, str(empty))
    path = str(tmp_path / "scored")
    write_jsonl(scored([scored_row(cve_id=f"C{i}", composite_score=0.5 + i / 100) for i in range(25)]), path)
    run = generate_report(spark, path, str(tmp_path / "report"))
    assert set(run.tables) == {
        "headline_stats", "median_score", "credibility_iqr", "modal_severity", "top20_stats", "readiness_breakdown",
        "score_histogram", "dimension_summary", "severity_distribution", "top20_table", "heatmap", "callout_facts"}
    assert spark.read.json(run.tables["score_histogram"]).count() == 21


def test_shared_report_equals_standalone_tables(spark):
    from vulnsift.queries import REPORT_QUERIES, scored_records
    from vulnsift.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    scored_df = scored_records(spark, "/root/testdata/sf0.01")
    shared = report.build_report(scored_df, materialise=lambda df: df.checkpoint(eager=True))
    assert set(shared) == set(REPORT_QUERIES)
    for name, table in shared.items():
        alone = REPORT_QUERIES[name](spark, "/root/testdata/sf0.01")
        assert sorted(table.columns) == sorted(alone.columns), name
        key = lambda df: sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
        assert key(table) == key(alone), name


def test_nan_composite_is_in_no_band_or_bin(scored):
    rows = [scored_row(composite_score=float("nan")), scored_row(composite_score=0.7)]
    bands = {r["bucket"]: r["count"] for r in report.readiness_breakdown(scored(rows)).collect()}
    assert bands == {"Training Ready": 1, "Review Queue": 0, "Rejected": 0}
    assert sum(r["count"] for r in report.score_histogram(scored(rows)).collect()) == 1
