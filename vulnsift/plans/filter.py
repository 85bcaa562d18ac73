"""End-to-end filter stage: exclusions → tiers → sample → decontamination → routes.

Exclusions, tiers and their counts are map-side. The sample (at most 5 × quota
rows, a bound fixed by the configuration) is a two-level top-k whose first level
limits each task's rows before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.operators.filtering import (
    apply_stratified_sample,
    tier_expr,
    with_contamination_flag,
    with_exclusion_reason,
)
from vulnsift.schemas import ROUTED_SCHEMA
from vulnsift.session import published_folder, stored
from vulnsift.sources.stagefiles import read_stage, write_stage


def classify(scored: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add ``exclusion_reason`` and, for kept records, ``tier``."""
    reasoned = with_exclusion_reason(scored)
    return reasoned.withColumn("tier", F.when(F.col("exclusion_reason").isNull(), tier_expr(cfg)))


def ready_tier(classified: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Kept records of the ready tier.

    For a positive threshold the plain ``composite_score >= threshold``
    conjunct is implied by the tier (a missing composite counts as 0) and lets
    a Parquet scan skip row groups by their min/max statistics.
    """
    ready = F.col("tier") == F.lit(K.TIER_READY)
    if cfg.quality_threshold > 0:
        ready = (F.col("composite_score") >= F.lit(cfg.quality_threshold)) & ready
    return classified.filter(ready)


def sample_of(classified: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """The severity-balanced sample of the ready tier, with ``contamination_flag``."""
    ready = ready_tier(classified, cfg)
    return with_contamination_flag(apply_stratified_sample(ready, cfg=cfg), cfg)


def route_expr() -> Column:
    return (
        F.when(F.col("exclusion_reason").isNotNull(), F.lit(K.ROUTE_REJECTED))
        .when(F.col("tier") == F.lit(K.TIER_REVIEW), F.lit(K.ROUTE_REVIEW))
        .when(F.col("sampled") & F.col("contamination_flag"), F.lit(K.ROUTE_FLAGGED))
        .when(F.col("sampled"), F.lit(K.ROUTE_FINAL))
    )


def _tier_counts() -> list[Column]:
    tier = F.col("tier")
    return [
        F.count(F.lit(1)).alias("total_input"),
        F.count_if(F.col("exclusion_reason").isNotNull()).alias("hard_excluded"),
        F.count_if(tier == F.lit(K.TIER_READY)).alias("training_ready_raw"),
        F.count_if(tier == F.lit(K.TIER_REVIEW)).alias("review_queue"),
        F.count_if(tier == F.lit(K.TIER_REJECTED)).alias("tier_rejected"),
    ]


def _sample_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(~F.col("contamination_flag")).alias("training_final"),
        F.count_if(F.col("contamination_flag")).alias("flagged_contamination"),
    ]


def filter_summary(scored: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """The eight stage counts as one row.

    Two passes, and neither moves the records: one counts by tier (partial sums of each
    task), the other draws the sample as the filter run does, at most quota rows of a
    group and task before each shuffle. The sample is stored, its counts are lazy.
    """
    classified = classify(scored, cfg)
    tiers = classified.agg(*_tier_counts()).first().asDict()
    sample = stored(sample_of(classified, cfg).select("contamination_flag"), "sample")
    drawn = sample.agg(*_sample_counts())
    return drawn.select(*[F.lit(n).cast("long").alias(name) for name, n in tiers.items()], *drawn.columns)


@dataclass
class FilterRun:
    summary: dict[str, int]
    output_dir: str


LARGE_ROUTES = (K.ROUTE_REJECTED, K.ROUTE_REVIEW)
SAMPLE_ROUTES = (K.ROUTE_FINAL, K.ROUTE_FLAGGED)


def run_filter_pipeline(
    scored: DataFrame, output_dir: str, cfg: CurationConfig = DEFAULT_CONFIG, fmt: str = "json"
) -> FilterRun:
    """Write the four routes under ``output_dir/route=<name>/`` and return the counts.

    All or nothing: the routes are written to a staging folder beside ``output_dir``,
    which takes its place when all are complete. A run that fails leaves the routes of the
    run before as they were. All four folders exist after a run, empty routes included. The rejected and review routes need no sample information, so
    they are written from one pass over the classified records, which also
    yields the tier counts (an observation). The sample is stored in the shared
    checkpoint folder and written in its order (severity group, then composite
    descending). Two passes over the scored records in all.
    """
    with published_folder(scored.sparkSession, output_dir) as staging:
        summary = _write_routes(scored, staging, cfg, fmt)
    return FilterRun(summary=summary, output_dir=output_dir)


def _write_routes(scored: DataFrame, folder: str, cfg: CurationConfig, fmt: str) -> dict[str, int]:
    classified = classify(scored, cfg)
    sample = stored(sample_of(classified, cfg), "sample")
    observed_counts = Observation("filter_counts")
    # The observation sits below the route filter, so it sees every record.
    observed = classified.observe(observed_counts, *_tier_counts())
    large = observed.filter(
        F.col("exclusion_reason").isNotNull() | (F.col("tier") == F.lit(K.TIER_REVIEW))
    ).withColumns({"sampled": F.lit(None).cast("boolean"), "contamination_flag": F.lit(None).cast("boolean")})
    large = large.withColumn("route", route_expr()).drop("sampled", "contamination_flag")
    small = sample.withColumn("contamination_flag", F.when(F.col("contamination_flag"), F.lit(True)))
    small = small.withColumn("route", route_expr())
    small = small.repartitionByRange("route", "severity_rank", "sample_rank").sortWithinPartitions("route", "severity_rank", "sample_rank")
    for routes in (large, small):
        write_stage(routes, folder, fmt, mode="append", partition_by="route")
    drawn = sample.agg(*_sample_counts()).first().asDict()
    summary = {k: int(v) for k, v in {**observed_counts.get, **drawn}.items()}
    rows = {
        K.ROUTE_REJECTED: summary["hard_excluded"], K.ROUTE_REVIEW: summary["review_queue"],
        K.ROUTE_FINAL: summary["training_final"], K.ROUTE_FLAGGED: summary["flagged_contamination"],
    }
    for route, n in rows.items():
        if not n:
            empty = (large if route in LARGE_ROUTES else small).drop("route").limit(0)
            write_stage(empty, f"{folder}/route={route}", fmt)
    return summary


def read_route(spark, output_dir: str, route: str, schema=None, fmt: str = "json") -> DataFrame:
    """Read one written route back (schema defaults to the routed record schema)."""
    return read_stage(spark, f"{output_dir}/route={route}", schema or ROUTED_SCHEMA, fmt)
