"""JSON-lines scan/sink, landed feeds and the stage runner end to end."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F

from conftest import SF_SMALL, scored_row
from vulnsift.operators.merge import keep_first, record_order
from vulnsift.operators.normalise import normalise_mirror_rows, normalise_primary_pages
from vulnsift.plans.filter import run_filter_pipeline
from vulnsift.plans.report import load_scored
from vulnsift.plans.stages import StagePaths, run_stages
from vulnsift.queries import q_ingest_counts
from vulnsift.schemas import MIRROR_COLUMNS, RECORD_SCHEMA, SCORED_SCHEMA
from vulnsift.sources.fixture import mirror_rows, primary_pages
from vulnsift.sources.jsonl import EmptyInputError, read_jsonl, write_jsonl
from vulnsift.sources.landing import read_mirror, read_primary_pages
from vulnsift.sources.stagefiles import write_stage


def test_jsonl_round_trip_keeps_nulls(spark, scored, tmp_path):
    df = scored([scored_row(severity=None, cvss_score=None, cwe_ids=[], description="Ünïcödé text")])
    path = str(tmp_path / "out")
    write_jsonl(df, path)
    lines = [ln for p in (tmp_path / "out").glob("part-*.json") for ln in p.read_text(encoding="utf-8").splitlines()]
    obj = json.loads(lines[0])
    assert "severity" in obj and obj["severity"] is None and obj["cvss_score"] is None
    back = read_jsonl(spark, path, SCORED_SCHEMA).first().asDict()
    assert back == df.first().asDict()
    write_jsonl(df.limit(0), path)  # overwrite
    assert read_jsonl(spark, path, SCORED_SCHEMA).count() == 0


def test_jsonl_reader_guards(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"cve_id": "A", "ord": 0}\n\n   \n{"cve_id": "B", "ord": 1}\n')
    assert read_jsonl(spark, str(good), RECORD_SCHEMA).count() == 2
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"cve_id": "A"}\n{not json\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(bad), RECORD_SCHEMA).collect()
    with pytest.raises(AnalysisException):
        read_jsonl(spark, str(tmp_path / "missing"), RECORD_SCHEMA)
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    with pytest.raises(EmptyInputError):
        read_jsonl(spark, str(empty), RECORD_SCHEMA, require_rows=True)


def _land(spark, tmp_path):
    """Land the derived feeds: JSON lines with a page on each, a CSV mirror."""
    pages, mirror = str(tmp_path / "landing" / "pages"), str(tmp_path / "landing" / "mirror")
    primary_pages(spark, SF_SMALL, only_source="nvd").write.json(pages)
    mirror_rows(spark, SF_SMALL, exclude_source="nvd").write.option("header", True).option("escape", '"').csv(mirror)
    return pages, mirror


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_stage_runner_end_to_end(spark, tmp_path, fmt):
    pages, mirror = _land(spark, tmp_path)
    paths = StagePaths(str(tmp_path / "work"))
    # The texts hold line breaks, so the CSV needs the reader that allows them.
    result = run_stages(spark, "all", paths, pages, mirror, "csv-multiline", False, scored_at="2025-01-01T00:00:00Z", fmt=fmt)
    expected = q_ingest_counts(spark, SF_SMALL).first().asDict()
    assert result.ingest == expected
    assert result.score["total"] == expected["total"]
    from vulnsift.operators.summaries import score_summary
    from vulnsift.plans.filter import filter_summary
    from vulnsift.plans.report import load_scored

    scored = load_scored(spark, paths.scored, fmt)
    assert result.score == pytest.approx(score_summary(scored).first().asDict())
    assert result.filter == filter_summary(scored).first().asDict()
    assert len(result.report) == 12
    assert scored.select("ord").distinct().count() == expected["total"]
    # stages can be re-run one at a time over the written files
    assert run_stages(spark, "filter", paths, fmt=fmt).filter == result.filter
    with pytest.raises(ValueError):
        run_stages(spark, "ingest", paths)


def test_one_page_per_file(spark, tmp_path):
    for start, ids in ((2, "CD"), (0, "AB")):
        page = {"startIndex": start, "vulnerabilities": [{"cve": {"id": i}} for i in ids]}
        (tmp_path / f"{9 - start}.json").write_text(json.dumps(page, indent=2))
    got = normalise_primary_pages(read_primary_pages(spark, str(tmp_path)))
    assert [r["cve_id"] for r in got.orderBy("ord").collect()] == list("ABCD")


def test_pages_without_positions_follow_their_files(spark, tmp_path):
    for name, ids in (("b", "CA"), ("a", "AB"), ("c", "D" * 400)):
        page = {"vulnerabilities": [{"cve": {"id": i, "published": name}} for i in ids]}
        (tmp_path / f"{name}.json").write_text(json.dumps(page))
    got = keep_first(normalise_primary_pages(read_primary_pages(spark, str(tmp_path))))
    rows = [(r["cve_id"], r["published"]) for r in got.orderBy(*record_order(got)).collect()]
    assert rows == [("A", "a"), ("B", "a"), ("C", "b"), ("D", "c")]


@pytest.mark.parametrize("with_ord", [True, False])
def test_mirror_formats(spark, tmp_path, with_ord):
    rows = mirror_rows(spark, SF_SMALL).coalesce(1).orderBy("ord")
    flat = rows.withColumn("DESCRIPTION", F.regexp_replace("DESCRIPTION", "\n", " "))
    drop = [] if with_ord else ["ord"]
    rows.drop(*drop).write.parquet(str(tmp_path / "pq"))
    rows.drop(*drop).write.option("header", True).option("escape", '"').csv(str(tmp_path / "multi"))
    swapped = flat.select("CWE-ID", *[c for c in flat.columns if c not in ("CWE-ID", *drop)])
    swapped.write.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    key = lambda df: [(r["cve_id"], r["cvss_score"], r["severity"]) for r in normalise_mirror_rows(df).orderBy("ord").collect()]
    want = key(rows)
    assert key(read_mirror(spark, str(tmp_path / "pq"), "parquet")) == want
    assert key(read_mirror(spark, str(tmp_path / "multi"), "csv-multiline")) == want
    assert key(read_mirror(spark, str(tmp_path / "csv"), "csv")) == want


def test_mirror_errors(spark, tmp_path):
    spark.createDataFrame([("CVE-1",)], "`CVE-ID` string").write.parquet(str(tmp_path / "pq"))
    with pytest.raises(ValueError, match="lacks the columns"):
        read_mirror(spark, str(tmp_path / "pq"), "parquet")
    with pytest.raises(ValueError, match="unsupported"):
        read_mirror(spark, str(tmp_path / "pq"), "orc")


def test_line_csv_splits_over_tasks(spark, tmp_path):
    line = ",".join(["CVE-2020-1", "x" * 500, "", "5.0", "", "LOW", "CWE-1"]) + "\n"
    (tmp_path / "m.csv").write_text(",".join(MIRROR_COLUMNS) + "\n" + line * 4000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        scan = spark.read.option("header", True).csv(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 1
        got = read_mirror(spark, str(tmp_path), "csv")
        assert got.count() == 4000 == got.select("ord").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_stage_file_without_positions(spark, scored, tmp_path, fmt):
    rows = [scored_row(cve_id=f"CVE-2008-{i:04d}", composite_score=0.75) for i in range(30)]
    path = str(tmp_path / "scored")
    write_stage(scored(rows).coalesce(1).orderBy("ord").drop("ord"), path, fmt)
    back = load_scored(spark, path, fmt)
    assert [r["cve_id"] for r in back.orderBy("ord").collect()] == [r["cve_id"] for r in rows]
    out = run_filter_pipeline(back, str(tmp_path / "out"))
    assert (out.summary["training_ready_raw"], out.summary["sampled"], out.summary["training_final"]) == (30, 30, 30)


def test_missing_and_empty_inputs(spark, scored, tmp_path):
    for path in (str(tmp_path / "no"), f"file:{tmp_path}/no"):
        with pytest.raises(FileNotFoundError):
            load_scored(spark, path)
    write_stage(scored([]), str(tmp_path / "none"), "json")
    for path in (str(tmp_path / "none"), f"file:{tmp_path}/none"):
        with pytest.raises(EmptyInputError):
            load_scored(spark, path)
