"""Stage runner: ingest → score → filter → report over stage files.

Each stage reads the previous stage's written output, so every stage
boundary is also a lineage cut: a lost executor re-runs at most the current
stage. Stage files are Parquet by default (``--format json`` writes JSON
lines instead); report tables are small JSON files.

    python -m vulnsift.plans.stages --stage all --pages landing/pages \\
        --mirror landing/mirror.csv --work data/
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field

from pyspark.sql import Observation, SparkSession

from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.operators.scoring import score_dataset
from vulnsift.operators.summaries import finish_score_summary, score_summary_exprs
from vulnsift.plans.filter import run_filter_pipeline
from vulnsift.plans.ingest import ingest
from vulnsift.plans.report import generate_report, load_scored
from vulnsift.schemas import RECORD_SCHEMA
from vulnsift.session import input_bytes, sized_shuffles
from vulnsift.sources.landing import MIRROR_FORMATS
from vulnsift.sources.stagefiles import FORMATS, read_stage, write_stage

STAGES = ("ingest", "score", "filter", "report", "all")


def observe_stage(df, name: str):
    """Mark ``df`` as the output of stage ``name`` with record/ready counts as metrics.

    The metrics are delivered with the first action (``Observation.get`` or the
    query listener); the marker is also where Catalyst stops pushing the next
    stage's filters down, so they read the stage's columns.
    """
    from pyspark.sql import functions as F

    metrics = [F.count(F.lit(1)).alias("records")]
    if "training_ready" in df.columns:
        metrics.append(F.count_if(F.coalesce(F.col("training_ready"), F.lit(False))).alias("ready"))
    return df.observe(name, *metrics)


@dataclass
class StagePaths:
    work: str
    raw: str = ""
    scored: str = ""
    filtered: str = ""
    report: str = ""

    def __post_init__(self) -> None:
        self.raw = self.raw or f"{self.work}/raw/records"
        self.scored = self.scored or f"{self.work}/scored/records"
        self.filtered = self.filtered or f"{self.work}/filtered"
        self.report = self.report or f"{self.work}/report"


@dataclass
class RunResult:
    ingest: dict = field(default_factory=dict)
    score: dict = field(default_factory=dict)
    filter: dict = field(default_factory=dict)
    report: dict = field(default_factory=dict)


def run_score_stage(
    spark: SparkSession,
    raw_path: str,
    scored_path: str,
    cfg: CurationConfig,
    scored_at: str | None = None,
    fmt: str = "parquet",
) -> dict:
    """Score the raw records; the stage summary is observed on the write (one pass)."""
    raw = read_stage(spark, raw_path, RECORD_SCHEMA, fmt)
    summary = Observation("score_summary")
    scored = score_dataset(raw, scored_at=scored_at, cfg=cfg)
    write_stage(scored.observe(summary, *score_summary_exprs()), scored_path, fmt)
    return finish_score_summary(summary.get)


def run_stages(
    spark: SparkSession,
    stage: str,
    paths: StagePaths,
    pages_path: str | None = None,
    mirror_path: str | None = None,
    mirror_format: str = "csv",
    one_page_per_file: bool = True,
    cfg: CurationConfig = DEFAULT_CONFIG,
    scored_at: str | None = None,
    fmt: str = "parquet",
) -> RunResult:
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if stage in ("ingest", "all") and not (pages_path and mirror_path):
        raise ValueError("the ingest stage needs the landed pages and mirror paths")
    result = RunResult()
    with sized_shuffles(spark, input_bytes(spark, pages_path or "", mirror_path or "", paths.raw, paths.scored)):
        if stage in ("ingest", "all"):
            result.ingest = ingest(spark, pages_path, mirror_path, paths.raw, mirror_format, one_page_per_file, fmt).counts
        if stage in ("score", "all"):
            result.score = run_score_stage(spark, paths.raw, paths.scored, cfg, scored_at, fmt)
        if stage in ("filter", "all"):
            result.filter = run_filter_pipeline(load_scored(spark, paths.scored, fmt), paths.filtered, cfg, fmt).summary
        if stage in ("report", "all"):
            result.report = generate_report(spark, paths.scored, paths.report, cfg, fmt).tables
    return result


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Vulnerability-record curation on Spark")
    parser.add_argument("--stage", choices=STAGES, default="all")
    parser.add_argument("--work", required=True, help="folder for stage outputs")
    parser.add_argument("--pages", help="landed primary-feed pages (JSON)")
    parser.add_argument("--mirror", help="landed mirror rows")
    parser.add_argument("--pages-per-line", action="store_true", help="JSON lines with a page on each line")
    parser.add_argument("--mirror-format", default="csv", choices=MIRROR_FORMATS)
    parser.add_argument("--format", default="parquet", choices=FORMATS, help="stage file format")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("vulnsift").getOrCreate()
    result = run_stages(
        spark, args.stage, StagePaths(args.work), args.pages, args.mirror, args.mirror_format, not args.pages_per_line, fmt=args.format
    )
    print(json.dumps(result.__dict__, indent=2, default=str))


if __name__ == "__main__":
    main()
