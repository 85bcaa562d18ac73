"""Hard exclusions, tiers, the severity-balanced sample and decontamination.

All but the sample are narrow column expressions. The sample is a per-group
top-k: ``row_number() <= k`` over ``partitionBy(severity group)``, which Spark
plans with a partial ``WindowGroupLimit`` before the shuffle, so each map task
ships at most k rows per group however skewed the groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.functions import per_session
from vulnsift.functions.dates import with_parsed_date
from vulnsift.functions.numbers import is_real
from vulnsift.functions.text import is_blank


@per_session
def exclusion_reason_expr() -> Column:
    """Reasons joined with '; ' in fixed order; '' when the record is kept.

    Missing clarity or credibility scores count as 1.0 (never a reason).
    """
    clarity = F.coalesce(F.col("clarity_score"), F.lit(1.0))
    credibility = F.coalesce(F.col("source_credibility_score"), F.lit(1.0))
    return F.concat_ws(
        K.REASON_SEPARATOR,
        F.when(clarity == F.lit(0.0), F.lit(K.REASON_CLARITY)),
        F.when(is_blank(F.col("description")), F.lit(K.REASON_BLANK)),
        F.when(credibility < F.lit(K.CREDIBILITY_FLOOR), F.lit(K.REASON_UNTRUSTED)),
    )


def with_exclusion_reason(df: DataFrame) -> DataFrame:
    """Add ``exclusion_reason``: the reasons text, or null for kept records."""
    reason = exclusion_reason_expr()
    return df.withColumn("exclusion_reason", F.when(reason != F.lit(""), reason))


def apply_hard_exclusions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (kept, excluded); excluded rows carry ``exclusion_reason``."""
    flagged = with_exclusion_reason(df)
    kept = flagged.filter(F.col("exclusion_reason").isNull()).drop("exclusion_reason")
    excluded = flagged.filter(F.col("exclusion_reason").isNotNull())
    return kept, excluded


@per_session
def tier_expr(cfg: CurationConfig = DEFAULT_CONFIG) -> Column:
    """training_ready ≥ threshold; review_queue ≥ review floor; else rejected.

    A missing composite counts as 0.0; NaN is never above a bound.
    """
    score = F.coalesce(F.col("composite_score"), F.lit(0.0))
    real = is_real(score)
    return (
        F.when(real & (score >= F.lit(cfg.quality_threshold)), F.lit(K.TIER_READY))
        .when(real & (score >= F.lit(cfg.review_floor)), F.lit(K.TIER_REVIEW))
        .otherwise(F.lit(K.TIER_REJECTED))
    )


def apply_tiered_filter(df: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add the ``tier`` column; callers filter per tier (one pass, no split)."""
    return df.withColumn("tier", tier_expr(cfg))


@per_session
def severity_group_expr() -> Column:
    """Upper-cased severity, with null/'' counted as UNKNOWN."""
    sev = F.col("severity")
    return F.upper(F.coalesce(F.when(sev != F.lit(""), sev), F.lit(K.UNKNOWN_SEVERITY)))


def severity_rank_expr(group: Column) -> Column:
    """Position of the group in the fixed output order (null for other groups)."""
    rank = None
    for i, name in enumerate(K.SEVERITY_ORDER):
        cond = group == F.lit(name)
        rank = F.when(cond, F.lit(i)) if rank is None else rank.when(cond, F.lit(i))
    return rank


@per_session
def severity_rank_of_group() -> Column:
    return severity_rank_expr(severity_group_expr())


# Hash buckets of the first top-k level: a group's candidates are ranked in this
# many tasks before the final ranking of the group.
SAMPLE_BUCKETS = 64


def sample_order() -> list[Column]:
    """Best composite first (missing = 0), then the earlier record; records of one
    or no ``ord`` by id and text, so that the sample doesn't depend on partitioning."""
    composite = F.coalesce(F.col("composite_score"), F.lit(0.0))
    return [composite.desc(), F.col("ord").asc_nulls_last(), F.col("cve_id"), F.xxhash64("cve_id", "severity", "published")]


def apply_stratified_sample(
    df: DataFrame,
    target_per_severity: int | None = None,
    cfg: CurationConfig = DEFAULT_CONFIG,
    buckets: int = SAMPLE_BUCKETS,
) -> DataFrame:
    """Top-k records per severity group by composite (ties: earlier ``ord``).

    Groups are CRITICAL, HIGH, MEDIUM, LOW and UNKNOWN; records of any other
    severity (e.g. NONE) are not sampled. ``severity`` itself is unchanged.
    Adds ``sampled`` (true), ``severity_rank`` (group position) and
    ``sample_rank`` (1..k within the group) so consumers can restore the
    order CRITICAL → UNKNOWN, composite descending.

    One pass: the top k of each (group, hash bucket), then the top k of each
    group among those at most ``buckets`` × k. Exact, as a record in its group's
    top k is in the top k of its bucket. Both levels limit the rows of a task
    before its shuffle, and columns that are not used later are not carried.
    """
    k = cfg.per_severity_quota if target_per_severity is None else target_per_severity
    ranked = df.withColumn("severity_rank", severity_rank_of_group()).filter(F.col("severity_rank").isNotNull())
    bucket = F.pmod(F.xxhash64("ord", "cve_id", "published"), F.lit(buckets))
    in_bucket = Window.partitionBy("severity_rank", "_bucket").orderBy(*sample_order())
    first = ranked.withColumn("_bucket", bucket).withColumn("_r", F.row_number().over(in_bucket)).filter(F.col("_r") <= F.lit(k))
    in_group = Window.partitionBy("severity_rank").orderBy(*sample_order())
    chosen = first.drop("_r", "_bucket").withColumn("sample_rank", F.row_number().over(in_group))
    return chosen.filter(F.col("sample_rank") <= F.lit(k)).withColumn("sampled", F.lit(True))


def with_contamination_flag(
    df: DataFrame,
    cfg: CurationConfig = DEFAULT_CONFIG,
    cutoff_date: str | None = None,
    target: str = "contamination_flag",
) -> DataFrame:
    """Add ``target``: true when the parsed publication date is strictly after the cutoff."""
    cutoff = F.lit(cutoff_date or cfg.cutoff_date).cast("date")
    parsed = with_parsed_date(df, "published", "_pub_date")
    return parsed.withColumn(target, F.coalesce(F.col("_pub_date") > cutoff, F.lit(False))).drop("_pub_date")


def apply_decontamination(
    df: DataFrame,
    cutoff_date: str | None = None,
    cfg: CurationConfig = DEFAULT_CONFIG,
) -> tuple[DataFrame, DataFrame]:
    """Split into (clean, flagged); flagged rows carry ``contamination_flag`` = true.

    Unparseable or missing dates are clean.
    """
    marked = with_contamination_flag(df, cfg, cutoff_date, target="_post_cutoff")
    clean = marked.filter(~F.col("_post_cutoff")).drop("_post_cutoff")
    flagged = marked.filter(F.col("_post_cutoff")).drop("_post_cutoff").withColumn(
        "contamination_flag", F.lit(True)
    )
    return clean, flagged
