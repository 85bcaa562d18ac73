"""Stage summaries: one-row aggregates computed in a single pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.functions.numbers import pct, round_stat
from vulnsift.functions.text import has_items
from vulnsift.operators.filtering import exclusion_reason_expr


def _means(prefix: str = "avg_") -> list[Column]:
    """Mean of each score over the records that have it (0 when none do)."""
    return [
        round_stat(F.coalesce(F.avg(F.col(c)), F.lit(0.0))).alias(prefix + c.replace("_score", "").replace("source_", ""))
        for c in K.SCORE_COLUMNS
    ]


def score_summary(scored: DataFrame) -> DataFrame:
    """Total, ready count and share, and the five score means."""
    total = F.count(F.lit(1))
    ready = F.count_if(F.coalesce(F.col("training_ready"), F.lit(False)))
    return scored.agg(
        total.alias("total"),
        ready.alias("ready_count"),
        round_stat(pct(ready, total)).alias("ready_pct"),
        *_means(),
    )


def score_summary_exprs() -> list[Column]:
    """Aggregates of ``score_summary`` usable as observed metrics (raw means)."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.col("training_ready"), F.lit(False))).alias("ready_count"),
        *[F.avg(F.col(c)).alias("avg_" + c.replace("_score", "").replace("source_", "")) for c in K.SCORE_COLUMNS],
    ]


def finish_score_summary(metrics: dict) -> dict:
    """Turn observed ``score_summary_exprs`` into the ``score_summary`` row."""
    total, ready = int(metrics["total"]), int(metrics["ready_count"])
    out = {"total": total, "ready_count": ready, "ready_pct": round(ready * 100.0 / total, 6) if total else 0.0}
    for key, value in metrics.items():
        if key.startswith("avg_"):
            out[key] = round(value, 6) if value is not None else 0.0
    return out


def data_card_stats(scored: DataFrame) -> DataFrame:
    """The dataset-statistics table of the data card, as one row."""
    total = F.count(F.lit(1))
    ready = F.count_if(F.coalesce(F.col("training_ready"), F.lit(False)))
    src = F.col("source")
    return scored.agg(
        total.alias("total_records"),
        F.count_if(src == F.lit(K.SOURCE_PRIMARY)).alias("nvd_records"),
        F.count_if(src == F.lit(K.SOURCE_MIRROR)).alias("huggingface_records"),
        F.count_if(exclusion_reason_expr() == F.lit("")).alias("passing_hard_filters"),
        ready.alias("training_ready"),
        round_stat(pct(ready, total)).alias("pass_rate"),
        *_means(),
        F.count_if(F.col("cvss_score").isNotNull()).alias("with_cvss"),
        F.count_if(has_items(F.col("cwe_ids"))).alias("with_cwe"),
    )
