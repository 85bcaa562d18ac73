"""Incremental scoring: each run scores only newly landed files, exactly once."""

from __future__ import annotations

import json

from conftest import text_of
from vulnsift.operators.scoring import compute_composite
from vulnsift.schemas import RECORD_SCHEMA
from vulnsift.streaming.incremental import start_incremental_scoring


def _land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def _row(i, **kw):
    base = {"ord": i, "cve_id": f"CVE-2024-{i:05d}", "description": text_of(120, "An injection flaw. "),
            "published": "2024-09-01" if i % 2 else "2023-01-01", "cvss_score": 7.5, "severity": "HIGH",
            "cwe_ids": ["CWE-89"], "source": "nvd"}
    base.update(kw)
    return base


def test_incremental_scoring(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "scored"), str(tmp_path / "ckpt")
    first = [_row(i) for i in range(5)] + [_row(5, description="")]
    _land(raw, "a.json", first)
    start_incremental_scoring(spark, str(raw), out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 6
    batch = compute_composite(spark.createDataFrame(first, RECORD_SCHEMA)).select("cve_id", "composite_score")
    expected = {r["cve_id"]: r["composite_score"] for r in batch.collect()}
    assert {r["cve_id"]: r["composite_score"] for r in got.collect()} == expected
    row = got.filter("cve_id = 'CVE-2024-00005'").first()
    assert row["exclusion_reason"] and row["tier"] is None
    assert got.filter("post_cutoff").count() == 3
    # a second run picks up only the new file
    _land(raw, "b.json", [_row(i) for i in range(10, 13)])
    start_incremental_scoring(spark, str(raw), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 9
    assert all(r["scored_at"].endswith("Z") for r in spark.read.parquet(out).collect())


def test_incremental_scoring_dedups_within_horizon(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "scored"), str(tmp_path / "ckpt")
    _land(raw, "a.json", [_row(1), _row(2), _row(1, source="huggingface")])
    start_incremental_scoring(spark, str(raw), out, ckpt, dedup_horizon="1 hour").awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r["cve_id"] for r in got.collect()) == ["CVE-2024-00001", "CVE-2024-00002"]
    _land(raw, "b.json", [_row(2, source="huggingface"), _row(3)])
    start_incremental_scoring(spark, str(raw), out, ckpt, dedup_horizon="1 hour").awaitTermination()
    assert sorted(r["cve_id"] for r in spark.read.parquet(out).collect()) == [
        "CVE-2024-00001", "CVE-2024-00002", "CVE-2024-00003"]


def test_incremental_scoring_from_parquet(spark, tmp_path):
    from vulnsift.schemas import RECORD_SCHEMA as schema

    raw, out, ckpt = tmp_path / "raw", str(tmp_path / "scored"), str(tmp_path / "ckpt")
    spark.createDataFrame([_row(i) for i in range(4)], schema).write.parquet(str(raw / "batch1"))
    start_incremental_scoring(spark, str(raw / "batch1"), out, ckpt, fmt="parquet").awaitTermination()
    assert spark.read.parquet(out).count() == 4
