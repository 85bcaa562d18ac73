"""Registered queries: one Spark query per operator, each over the whole input.

Every query takes ``(spark, sf_dir)``, reads the driver tables (through the
derived record relation of ``vulnsift.sources.fixture``) and returns a
DataFrame whose columns match the oracle of the same name in
``vulnsift.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.functions.dates import with_parsed_date
from vulnsift.operators import filtering, merge, normalise, report, scoring, summaries
from vulnsift.plans import filter as filter_plan
from vulnsift.plans import ingest as ingest_plan
from vulnsift.plans import report as report_plan
from vulnsift.plans.stages import observe_stage
from vulnsift.schemas import RECORD_SCHEMA, SCORED_SCHEMA
from vulnsift.session import scratch_path
from vulnsift.sources.fixture import (
    PAGE_SIZE,
    cve_records,
    date_samples,
    landed_records,
    mirror_rows,
    numeric_mirror_rows,
    primary_pages,
)
from vulnsift.sources.stagefiles import read_stage, write_stage

Query = Callable[[SparkSession, str], DataFrame]

# Fixed batch timestamp for reproducible scored output.
FIXED_SCORED_AT = "2025-01-01T00:00:00Z"


def q_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_relevance(records(spark, sf_dir)).select("ord", "cve_id", "relevance_score")


def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_completeness(records(spark, sf_dir)).select("ord", "cve_id", "completeness_score")


def q_credibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_credibility(records(spark, sf_dir)).select(
        "ord", "cve_id", "source_credibility_score"
    )


def q_clarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_clarity(records(spark, sf_dir)).select("ord", "cve_id", "clarity_score")


def q_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.compute_composite(records(spark, sf_dir)).select(
        "ord",
        "cve_id",
        "relevance_score",
        "completeness_score",
        "source_credibility_score",
        "clarity_score",
        "composite_score",
        "training_ready",
    )


def _flat(df: DataFrame, *first: str) -> DataFrame:
    """Record columns with the id list rendered as text (for value comparison)."""
    return df.select(
        *(first or ("ord",)),
        "cve_id",
        "description",
        "published",
        "last_modified",
        "cvss_score",
        "severity",
        F.array_join("cwe_ids", ",").alias("cwe_ids"),
        F.size("cwe_ids").cast("long").alias("n_cwe"),
        "source",
    )


def q_nvd_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(normalise.normalise_primary_pages(primary_pages(spark, sf_dir)))


def q_hf_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of text columns, and the same rows with number columns."""
    text = normalise.normalise_mirror_rows(mirror_rows(spark, sf_dir)).withColumn("columns", F.lit("text"))
    numbers = normalise.normalise_mirror_rows(numeric_mirror_rows(spark, sf_dir)).withColumn("columns", F.lit("numbers"))
    return _flat(text.unionByName(numbers), "columns", "ord")


def _split_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    recs = records(spark, sf_dir)
    is_primary = F.col("source") == F.lit(K.SOURCE_PRIMARY)
    return recs.filter(is_primary), recs.filter(~is_primary)


def q_source_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, mirror = _split_sources(spark, sf_dir)
    return _flat(merge.drop_known_ids(mirror, primary))


def q_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full records of both feeds, with repeated landings and records without a position."""
    primary, mirror = _split_sources(spark, sf_dir)
    merged = merge.keep_first(merge.ordered_union(landed_records(primary), landed_records(mirror)))
    return _flat(merged, "src_rank", "ord")


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = primary_pages(spark, sf_dir, only_source=K.SOURCE_PRIMARY)
    return ingest_plan.ingest_frames(pages, mirror_rows(spark, sf_dir, exclude_source=K.SOURCE_PRIMARY))


def q_ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_ingested(spark, sf_dir), "src_rank")


def _land_pages(spark: SparkSession, sf_dir: str) -> str:
    """The derived primary feed landed as JSON lines, every fourth page without its position."""
    path = scratch_path(spark, "pages")
    pages = primary_pages(spark, sf_dir, only_source=K.SOURCE_PRIMARY, in_order=True)
    placed = F.col("startIndex") / PAGE_SIZE % 4 != 1
    pages.withColumn("startIndex", F.when(placed, F.col("startIndex"))).write.json(path)
    return path


def _land_mirror(spark: SparkSession, sf_dir: str, mirror_format: str) -> str:
    """The derived mirror landed as CSV without positions (where an empty text is a missing
    one), or as Parquet where some rows lack theirs."""
    path = scratch_path(spark, "mirror")
    rows = mirror_rows(spark, sf_dir, exclude_source=K.SOURCE_PRIMARY).orderBy("ord")
    if mirror_format == "parquet":
        unplaced = (F.col("ord") % 20 == 4) | (F.col("ord") % 10 == 7)
        rows.withColumn("ord", F.when(~unplaced, F.col("ord"))).write.parquet(path)
    else:
        rows.drop("ord").write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def q_ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest stage as users start it, on landed files: the stage file, read back. The
    primary feed is landed once, and ingested with either landing of the mirror."""
    pages_path = _land_pages(spark, sf_dir)
    out = []
    for mirror_format in ("csv-multiline", "parquet"):
        path = scratch_path(spark, "raw")
        ingest_plan.ingest(spark, pages_path, _land_mirror(spark, sf_dir, mirror_format), path, mirror_format, one_page_per_file=False)
        out.append(_flat(read_stage(spark, path, RECORD_SCHEMA).withColumn("mirror_format", F.lit(mirror_format)), "mirror_format", "ord"))
    return reduce(DataFrame.unionByName, out)


def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_plan.source_counts(_ingested(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cve_records(spark, sf_dir)


def scored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_dataset(records(spark, sf_dir), scored_at=FIXED_SCORED_AT)


def scored_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored records as a stage boundary (what the filter stage reads).

    In a run the score stage writes its output and the filter stage reads it.
    In these single-plan queries the boundary is an observed stage: the
    record and ready counts are collected as metrics (the score-stage
    summary), and filters of the next stage stay above it instead of being
    pushed into the scoring projection, where they would re-derive every
    score inside their predicates.
    """
    return observe_stage(scored_records(spark, sf_dir), "scored")


def _scored_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "ord",
        "cve_id",
        "description",
        "published",
        "last_modified",
        "cvss_score",
        "severity",
        F.array_join("cwe_ids", ",").alias("cwe_ids"),
        "source",
        *K.SCORE_COLUMNS,
        "training_ready",
        "pipeline_version",
        "scored_at",
    )


def q_score_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_columns(scored_records(spark, sf_dir))


def q_hard_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, excluded = filtering.apply_hard_exclusions(scored_stage(spark, sf_dir))
    return excluded.select("ord", "cve_id", "exclusion_reason")


def q_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = filtering.apply_hard_exclusions(scored_stage(spark, sf_dir))
    return filtering.apply_tiered_filter(kept).select("ord", "cve_id", "composite_score", "tier")


def _ranks() -> list:
    return [F.col("severity_rank").cast("long").alias("severity_rank"), F.col("sample_rank").cast("long").alias("sample_rank")]


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_plan.sample_of(filter_plan.classify(scored_stage(spark, sf_dir)))


def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).select(
        "ord", "cve_id", "severity", "composite_score", *_ranks(), "sampled"
    )


def date_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_samples(spark, sf_dir)


def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = with_parsed_date(date_sample_rows(spark, sf_dir), "published", "published_date")
    return parsed.select("ord", "published", F.col("published_date").cast("string").alias("published_date"))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = filtering.with_contamination_flag(scored_records(spark, sf_dir))
    return flagged.select("ord", "cve_id", "published", "contamination_flag")


def q_filter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_plan.filter_summary(scored_stage(spark, sf_dir))


def q_training_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the clean severity-balanced training sample."""
    return _sample(spark, sf_dir).filter(~F.col("contamination_flag")).select(
        "ord", "cve_id", "severity", "published", "composite_score", *_ranks()
    )


def q_routed_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter run as users start it: four routes written as JSON lines, read back."""
    out = scratch_path(spark, "routes")
    filter_plan.run_filter_pipeline(scored_stage(spark, sf_dir), out)
    routes = [filter_plan.read_route(spark, out, r).withColumn("route", F.lit(r)) for r in (*filter_plan.LARGE_ROUTES, *filter_plan.SAMPLE_ROUTES)]
    return reduce(DataFrame.unionByName, routes).select(
        "route", "ord", "cve_id", "description", "composite_score", "exclusion_reason", "tier", "sampled", "contamination_flag", *_ranks()
    )


def _scored_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "scored")
    write_stage(scored_records(spark, sf_dir), path, "json")
    return path


def q_scored_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored records written as JSON lines and read back."""
    return _scored_columns(read_stage(spark, _scored_file(spark, sf_dir), SCORED_SCHEMA, "json"))


def q_report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report run over a scored file: every value of its twelve tables, read back."""
    return report_plan.read_report(spark, report_plan.generate_report(spark, _scored_file(spark, sf_dir), scratch_path(spark, "report")))


# Summaries and report tables are aggregates and top-k over the scored records
# with no filter in front of them, so they run on the lazy scored frame: one
# pass from the documents, scoring fused into the aggregation stage.
def q_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.score_summary(scored_records(spark, sf_dir))


def q_data_card_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.data_card_stats(scored_records(spark, sf_dir))


def _report_query(builder: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(scored_records(spark, sf_dir))

    run.__name__ = f"q_{builder.__name__}"
    return run


REPORT_QUERIES: dict[str, Query] = {
    "headline_stats": _report_query(report.headline_stats),
    "median_score": _report_query(report.median_score),
    "credibility_iqr": _report_query(report.credibility_hinges),
    "modal_severity": _report_query(report.modal_severity),
    "top20_stats": _report_query(report.top20_stats),
    "readiness_breakdown": _report_query(report.readiness_breakdown),
    "score_histogram": _report_query(report.score_histogram),
    "dimension_summary": _report_query(report.dimension_summary),
    "severity_distribution": _report_query(report.severity_distribution),
    "top20_table": _report_query(report.top20_table),
    "heatmap": _report_query(report.heatmap),
    "callout_facts": _report_query(report.callout_facts),
}


def queries() -> dict[str, Query]:
    return {
        "nvd_normalise": q_nvd_normalise,
        "hf_normalise": q_hf_normalise,
        "source_anti_join": q_source_anti_join,
        "merge_dedup": q_merge_dedup,
        "ingest_records": q_ingest_records,
        "ingest_counts": q_ingest_counts,
        "ingest_files": q_ingest_files,
        "relevance": q_relevance,
        "completeness": q_completeness,
        "credibility": q_credibility,
        "clarity": q_clarity,
        "composite": q_composite,
        "score_dataset": q_score_dataset,
        "hard_exclusions": q_hard_exclusions,
        "tiers": q_tiers,
        "stratified_sample": q_stratified_sample,
        "parse_date": q_parse_date,
        "decontaminate": q_decontaminate,
        "filter_summary": q_filter_summary,
        "training_final": q_training_final,
        "routed_outputs": q_routed_outputs,
        "scored_jsonl": q_scored_jsonl,
        "report_run": q_report_run,
        "score_summary": q_score_summary,
        "data_card_stats": q_data_card_stats,
        **REPORT_QUERIES,
    }
