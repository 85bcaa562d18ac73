"""Scores against a plain restatement of their rules, over a grid of records."""

from __future__ import annotations

import itertools
import math

import pytest

from conftest import text_of
from vulnsift.config import SECURITY_KEYWORDS, CurationConfig
from vulnsift.operators import scoring

CVSS = (None, 0.0, 3.9, 4.0, 6.9, 7.0, 10.0)
WEAKNESSES = ([], ["CWE-77"], ["CWE-1", "CWE-2", "CWE-1"])
SOURCES = ("nvd", "NVD", "huggingface", "forum", None)
LENGTHS = (0, 49, 50, 99, 100, 1000, 1001, 2000, 2001, 5000, 5001)
WORDS = ((), ("xss",), ("exploit", "bypass"), ("exploit", "bypass", "xss", "privilege"))


def grid() -> list[dict]:
    """Records by rule: lengths × words × scores, the other fields in turn."""
    rows = []
    for i, (n, words, cvss) in enumerate(itertools.product(LENGTHS, WORDS, CVSS)):
        rows.append(
            dict(
                cve_id=f"CVE-1990-{i:05d}", description=text_of(n, " ".join(words) + " ")[:n], cvss_score=cvss,
                cwe_ids=WEAKNESSES[i % 3], source=SOURCES[i % 5], severity=(None, "", "LOW")[i % 3], published=("", "1990", None)[i % 3],
            )
        )
    return rows


def rules(r: dict) -> dict:
    """The four dimensions, the gate and the composite of one record."""
    text, n, cvss = r["description"] or "", len(r["description"] or ""), r["cvss_score"]
    hits = min(3, sum(k in text.lower() for k in SECURITY_KEYWORDS))
    relevance = min(1.0, (0.4 if (cvss or 0) >= 7 else 0.2 if (cvss or 0) >= 4 else 0) + (0.3 if r["cwe_ids"] else 0) + 0.1 * hits)
    has = (0.4, bool(text) and 50 <= n <= 5000), (0.2, cvss is not None), (0.1, bool(r["severity"])), (0.2, bool(r["cwe_ids"])), (0.1, bool(r["published"]))
    completeness = min(1.0, sum(points for points, present in has if present))
    credibility = min(1.0, {"nvd": 1.0, "huggingface": 0.6}.get((r["source"] or "").lower(), 0.3) + (0.1 if cvss is not None else 0))
    clarity = 1.0 if 100 <= n <= 1000 else 0.7 if 50 <= n <= 2000 else 0.4 if 2000 < n <= 5000 else 0.0
    out = dict(relevance_score=relevance, completeness_score=completeness, source_credibility_score=credibility, clarity_score=clarity)
    out["composite_score"] = 0.35 * relevance + 0.25 * completeness + 0.25 * credibility + 0.15 * clarity
    if not 50 <= n <= 5000:
        out = dict.fromkeys(out, 0.0)
    return out


@pytest.fixture(scope="module")
def scored_grid(spark):
    from vulnsift.schemas import RECORD_SCHEMA

    rows = [{f.name: None for f in RECORD_SCHEMA.fields} | {"ord": i} | r for i, r in enumerate(grid())]
    return scoring.compute_composite(spark.createDataFrame(rows, RECORD_SCHEMA)).collect()


def test_grid(scored_grid):
    assert len(scored_grid) == len(LENGTHS) * len(WORDS) * len(CVSS)
    for got, record in zip(sorted(scored_grid, key=lambda r: r["ord"]), grid()):
        want = rules(record)
        for name, value in want.items():
            assert math.isclose(got[name], value, abs_tol=1e-4), (record, name)
        assert got["training_ready"] is (got["composite_score"] >= 0.6)


@pytest.mark.parametrize("function,name", [
    (scoring.score_relevance, "relevance_score"), (scoring.score_completeness, "completeness_score"),
    (scoring.score_credibility, "source_credibility_score"), (scoring.score_clarity, "clarity_score"),
])
def test_single_dimensions_have_no_gate(records, function, name):
    rows = grid()[::17]
    got = [r[name] for r in function(records(rows)).orderBy("ord").collect()]
    gate = [50 <= len(r["description"]) <= 5000 for r in rows]
    want = [rules(r)[name] for r in rows]
    assert all(math.isclose(g, w) for g, w, open_ in zip(got, want, gate) if open_)
    if name == "source_credibility_score":
        assert min(got) >= 0.3


def test_missing_text_and_nan_scores(records):
    rows = [dict(description=None, cwe_ids=None), dict(description=text_of(120), cvss_score=math.nan, cwe_ids=[], source="nvd")]
    first, second = scoring.compute_composite(records(rows)).orderBy("ord").collect()
    assert first["composite_score"] == 0.0 and first["training_ready"] is False
    assert second["relevance_score"] == 0.0 and second["completeness_score"] == 0.6


@pytest.mark.parametrize(
    "text,hits",
    [
        ("Resource exhaustion", 1),  # 'rce' inside 'resource'
        ("Several vulnerabilities", 0),  # the plural does not contain 'vulnerability'
        ("A buffer overflow", 2),  # 'overflow' and 'buffer overflow'
        ("SQL injection", 1),  # 'sqli' is not in 'sql injection'
    ],
)
def test_keywords_are_substrings(records, text, hits):
    got = scoring.score_relevance(records([dict(description=text, cwe_ids=[])])).first()["relevance_score"]
    assert math.isclose(got, hits / 10)


def test_placeholders_have_no_clarity(records):
    texts = [text_of(400, "** RESERVED ** "), text_of(150) + " ** REJECT **", text_of(150, "** reserved ** ")]
    got = [r[0] for r in scoring.score_clarity(records([dict(description=t) for t in texts])).orderBy("ord").select("clarity_score").collect()]
    assert got == [0.0, 0.0, 1.0]


def test_length_counts_code_points(records):
    assert scoring.score_clarity(records([dict(description="é" * 50)])).first()["clarity_score"] == 0.7


def test_readiness_threshold_is_inclusive(records):
    row = grid()[len(WORDS) * len(CVSS) * 4 + 5]
    exact = scoring.compute_composite(records([row])).first()["composite_score"]
    cfg = CurationConfig(quality_threshold=exact, review_floor=0.0)
    assert scoring.compute_composite(records([row]), cfg).first()["training_ready"] is True


def test_score_dataset_keeps_input_and_stamps(records):
    df = scoring.score_dataset(records([grid()[200]]), scored_at="2030-01-02T03:04:05Z")
    row = df.first()
    assert row["cve_id"] == "CVE-1990-00200" and row["pipeline_version"] == "v0.1.0" and row["scored_at"] == "2030-01-02T03:04:05Z"
    now = scoring.score_dataset(records([grid()[200]])).first()["scored_at"]
    assert len(now) == 20 and now[10] == "T" and now.endswith("Z")


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        CurationConfig(weight_relevance=0.5)
