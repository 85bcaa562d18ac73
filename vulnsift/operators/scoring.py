"""Record scoring: four quality dimensions, the hard gate and the weighted composite.

Every score is a built-in column expression, so a scoring pass is one narrow
projection inside whole-stage codegen; no shuffle, no Python per row.

The base facts (description, its length, its lower-cased form, keyword hits)
are materialised once in a projection before the scores reference them, so
Catalyst does not re-evaluate the 13 substring tests per consumer.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.functions import per_session
from vulnsift.functions.numbers import is_real
from vulnsift.functions.text import contains_any, count_substrings_present, has_items, has_text

# Helper columns added by ``with_base_facts`` and dropped after scoring.
_DESC, _LOWER, _LEN, _HITS = "_desc", "_desc_lower", "_desc_len", "_kw_hits"
_BASE = (_DESC, _LOWER, _LEN, _HITS)


def with_base_facts(df: DataFrame) -> DataFrame:
    """Add description, its code-point length, its lower-cased form (computed
    once: the 13 keyword tests read it) and the capped keyword hit count."""
    desc = F.coalesce(F.col("description"), F.lit(""))
    staged = df.withColumns({_DESC: desc}).withColumns({_LOWER: F.lower(F.col(_DESC)), _LEN: F.length(F.col(_DESC))})
    return staged.withColumn(_HITS, keyword_hits_expr())


@per_session
def keyword_hits_expr() -> Column:
    """Number of keywords present in the lower-cased description, at most 3."""
    return F.least(count_substrings_present(F.col(_LOWER), K.SECURITY_KEYWORDS), F.lit(K.KEYWORD_CAP))


def _cvss_present() -> Column:
    return F.col("cvss_score").isNotNull()


@per_session
def relevance_expr() -> Column:
    """CVSS tier points + CWE points + 0.1 per keyword (at most 3), capped at 1."""
    cvss = F.col("cvss_score")
    tier = (
        F.when(is_real(cvss) & (cvss >= F.lit(K.CVSS_HIGH)), F.lit(K.CVSS_HIGH_POINTS))
        .when(is_real(cvss) & (cvss >= F.lit(K.CVSS_MEDIUM)), F.lit(K.CVSS_MEDIUM_POINTS))
        .otherwise(F.lit(0.0))
    )
    cwe = F.when(has_items(F.col("cwe_ids")), F.lit(K.CWE_POINTS)).otherwise(F.lit(0.0))
    keywords = F.col(_HITS).cast("double") * F.lit(K.KEYWORD_POINTS)
    return F.least(F.lit(0.0) + tier + cwe + keywords, F.lit(1.0))


@per_session
def completeness_expr(cfg: CurationConfig = DEFAULT_CONFIG) -> Column:
    """Points for an in-bounds description, CVSS, severity, CWE and publication date."""
    n = F.col(_LEN)
    in_bounds = (F.col(_DESC) != F.lit("")) & n.between(cfg.min_description_length, cfg.max_description_length)

    def pts(cond: Column, value: float) -> Column:
        return F.when(cond, F.lit(value)).otherwise(F.lit(0.0))

    total = (
        F.lit(0.0)
        + pts(in_bounds, K.COMPLETE_DESCRIPTION)
        + pts(_cvss_present(), K.COMPLETE_CVSS)
        + pts(has_text(F.col("severity")), K.COMPLETE_SEVERITY)
        + pts(has_items(F.col("cwe_ids")), K.COMPLETE_CWE)
        + pts(has_text(F.col("published")), K.COMPLETE_PUBLISHED)
    )
    return F.least(total, F.lit(1.0))


@per_session
def credibility_expr() -> Column:
    """Source base (primary 1.0, mirror 0.6, other 0.3) plus 0.1 with CVSS, capped at 1."""
    src = F.lower(F.coalesce(F.col("source"), F.lit("")))
    base = (
        F.when(src == F.lit(K.SOURCE_PRIMARY), F.lit(K.CREDIBILITY_PRIMARY))
        .when(src == F.lit(K.SOURCE_MIRROR), F.lit(K.CREDIBILITY_MIRROR))
        .otherwise(F.lit(K.CREDIBILITY_OTHER))
    )
    boost = F.when(_cvss_present(), F.lit(K.CREDIBILITY_CVSS_BOOST)).otherwise(F.lit(0.0))
    return F.least(base + boost, F.lit(1.0))


@per_session
def clarity_expr() -> Column:
    """0 for placeholder text; otherwise a value by description length band."""
    n = F.col(_LEN)
    banded = None
    for low, high, value in K.CLARITY_BANDS:
        cond = n.between(low, high)
        banded = F.when(cond, F.lit(value)) if banded is None else banded.when(cond, F.lit(value))
    banded = banded.otherwise(F.lit(0.0))
    return F.when(contains_any(F.col(_DESC), K.PLACEHOLDER_MARKERS), F.lit(0.0)).otherwise(banded)


@per_session
def gate_failed(cfg: CurationConfig = DEFAULT_CONFIG) -> Column:
    """Hard gate: empty description or length outside the configured bounds."""
    n = F.col(_LEN)
    return (F.col(_DESC) == F.lit("")) | ~n.between(cfg.min_description_length, cfg.max_description_length)


def _standalone(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return with_base_facts(df).withColumn(name, F.round(expr, 4)).drop(*_BASE)


def score_relevance(df: DataFrame) -> DataFrame:
    """Stand-alone relevance (no gate), rounded to 4 decimals."""
    return _standalone(df, "relevance_score", relevance_expr())


def score_completeness(df: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Stand-alone completeness (no gate), rounded to 4 decimals."""
    return _standalone(df, "completeness_score", completeness_expr(cfg))


def score_credibility(df: DataFrame) -> DataFrame:
    """Stand-alone source credibility (no gate), rounded to 4 decimals."""
    return _standalone(df, "source_credibility_score", credibility_expr())


def score_clarity(df: DataFrame) -> DataFrame:
    """Stand-alone clarity (no gate), rounded to 4 decimals."""
    return _standalone(df, "clarity_score", clarity_expr())


def compute_composite(df: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Gated dimension scores, weighted composite and the readiness flag.

    Gate-failed rows get 0.0 everywhere and are never ready. Otherwise the
    composite weighs the *unrounded* dimensions, is clamped to [0, 1] and
    rounded to 4 decimals; the dimensions are rounded to 4 decimals on output.
    """
    rel, comp, cred, clar = "_rel", "_comp", "_cred", "_clar"
    staged = with_base_facts(df).withColumns(
        {rel: relevance_expr(), comp: completeness_expr(cfg), cred: credibility_expr(), clar: clarity_expr()}
    )
    weighted = (
        F.lit(cfg.weight_relevance) * F.col(rel)
        + F.lit(cfg.weight_completeness) * F.col(comp)
        + F.lit(cfg.weight_credibility) * F.col(cred)
        + F.lit(cfg.weight_clarity) * F.col(clar)
    )
    composite = F.round(F.least(F.greatest(weighted, F.lit(0.0)), F.lit(1.0)), 4)
    failed = gate_failed(cfg)

    def gated(value: Column) -> Column:
        return F.when(failed, F.lit(0.0)).otherwise(value)

    scored = staged.withColumns(
        {
            "relevance_score": gated(F.round(F.col(rel), 4)),
            "completeness_score": gated(F.round(F.col(comp), 4)),
            "source_credibility_score": gated(F.round(F.col(cred), 4)),
            "clarity_score": gated(F.round(F.col(clar), 4)),
            "composite_score": gated(composite),
        }
    )
    scored = scored.withColumn(
        "training_ready", ~failed & (F.col("composite_score") >= F.lit(cfg.quality_threshold))
    )
    return scored.drop(rel, comp, cred, clar, *_BASE)


def score_dataset(
    df: DataFrame,
    scored_at: str | None = None,
    cfg: CurationConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Score every record, keep all input columns, add version and batch timestamp.

    ``scored_at`` is one value for the whole batch (text ``YYYY-MM-DDTHH:MM:SSZ``
    in UTC). Pass it explicitly for reproducible output; by default it is the
    current UTC time, taken once when the plan is built.
    """
    if scored_at is None:
        scored_at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return compute_composite(df, cfg).withColumns(
        {"pipeline_version": F.lit(cfg.pipeline_version), "scored_at": F.lit(scored_at)}
    )
