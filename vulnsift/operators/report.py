"""Report tables: the statistics and chart data of the curation report.

Every table is an aggregate or a bounded top-k over the scored records:

* one-pass aggregates (``count_if``/``avg``) with map-side partial aggregation;
* exact medians, quartiles and hinges by range refinement (``operators.quantiles``): a
  few passes over narrow columns, and no buffer grows with the number of values;
* global top-k as ``orderBy(...).limit(k)`` (TakeOrderedAndProject: every task
  keeps k rows, one task merges them);
* the modal severity from a count for each label.

A missing score counts as 0.0 throughout the report (unlike the stage
summaries, which average only present values).

Global tables are written as aggregate expressions plus a finisher over the
one-row result, so ``build_report`` can compute all of them in a single
aggregation pass; each table also has a stand-alone function.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.functions import per_session
from vulnsift.functions.numbers import pct, round_stat
from vulnsift.operators.filtering import severity_group_expr
from vulnsift.operators.quantiles import order_statistics


def _score(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _ready() -> Column:
    return F.coalesce(F.col("training_ready"), F.lit(False))


# R1 -------------------------------------------------------------------------
@per_session
def _headline_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(_ready()).alias("n_ready"),
        F.avg(_score("composite_score")).alias("avg_composite_all"),
    ]


def _headline_from(g: DataFrame) -> DataFrame:
    return g.select(
        F.col("n_total").alias("total"),
        F.col("n_ready").alias("ready_count"),
        round_stat(pct(F.col("n_ready"), F.col("n_total"))).alias("pass_rate"),
        round_stat(F.col("avg_composite_all")).alias("avg_composite"),
    )


def headline_stats(scored: DataFrame) -> DataFrame:
    return _headline_from(scored.agg(*_headline_aggs()))


# Order statistics -------------------------------------------------------------
def _spread(n: int, p: float) -> list[int]:
    """The ranks around position ``p`` of ``n`` sorted values."""
    at = p * (n - 1)
    return [math.floor(at) + 1, math.ceil(at) + 1]


def _hinge_ranks(n: int) -> list[list[int]]:
    """The middle ranks of the lower and of the upper ``n // 2`` values (the middle one is
    left out when n is odd)."""
    half = n // 2
    middle = [(half - 1) // 2 + 1, half // 2 + 1]
    return [middle, [n - half + r for r in middle]] if n >= 2 else []


@dataclass(frozen=True)
class OrderStats:
    """What the report needs of the sorted scores; None where there are too few."""

    median: float | None = None
    hinges: tuple[float, float] | None = None
    quartiles: dict[str, list[float]] = field(default_factory=dict)


QUARTERS = (0.25, 0.5, 0.75)


def order_stats(scored: DataFrame, median: bool = False, hinges: bool = False, quartiles: bool = False) -> OrderStats:
    """The chosen statistics over all records, exact, from shared passes."""
    names = {*(["composite_score"] if median else []), *(["source_credibility_score"] if hinges else []), *(K.DIMENSIONS if quartiles else [])}

    def ranks(n: int) -> dict[str, list[int]]:
        wanted = {name: [] for name in names}
        if n and median:
            wanted["composite_score"] += _spread(n, 0.5)
        if hinges:
            wanted["source_credibility_score"] += [r for rs in _hinge_ranks(n) for r in rs]
        if n and quartiles:
            for d in K.DIMENSIONS:
                wanted[d] += [r for p in QUARTERS for r in _spread(n, p)]
        return wanted

    n, at = order_statistics(scored, {name: _score(name) for name in sorted(names)}, ranks)

    def position(name: str, p: float) -> float:
        """Linear interpolation between the two ranks."""
        where, (low, high) = p * (n - 1), _spread(n, p)
        x, y = at[name, low], at[name, high]
        return x if x == y else (high - 1 - where) * x + (where - low + 1) * y

    credibility = [sum(at["source_credibility_score", r] for r in rs) / 2 for rs in _hinge_ranks(n)] if hinges else []
    return OrderStats(
        position("composite_score", 0.5) if n and median else None,
        tuple(credibility) or None,
        {d: [position(d, p) for p in QUARTERS] for d in K.DIMENSIONS} if n and quartiles else {},
    )


def _known(value: float | None) -> Column:
    return F.lit(value).cast("double")


# R2 -------------------------------------------------------------------------
def _median_from(one: DataFrame, stats: OrderStats) -> DataFrame:
    return one.select(round_stat(_known(stats.median)).alias("median_score"))


def median_score(scored: DataFrame) -> DataFrame:
    """Exact median of the composite (mean of the middle two for even counts)."""
    return _median_from(scored.sparkSession.range(1), order_stats(scored, median=True))


# R3 -------------------------------------------------------------------------
def _hinges_from(one: DataFrame, stats: OrderStats) -> DataFrame:
    q1, q3 = stats.hinges or (None, None)
    return one.select(
        round_stat(_known(q1)).alias("q1"), round_stat(_known(q3)).alias("q3"), round_stat(_known(q3) - _known(q1)).alias("iqr"),
    )


def credibility_hinges(scored: DataFrame) -> DataFrame:
    """Q1, Q3 and IQR of credibility by Tukey's hinges; null below two records.

    Q1 is the median of the lower ``n // 2`` sorted values, Q3 of the upper
    ``n // 2`` (the middle value is left out when n is odd).
    """
    return _hinges_from(scored.sparkSession.range(1), order_stats(scored, hinges=True))


# R4 -------------------------------------------------------------------------
def modal_severity(scored: DataFrame) -> DataFrame:
    """Most frequent severity label; ties go to the label seen first (of records with a
    position before those without), then to the greater label."""
    counts = scored.groupBy(severity_group_expr().alias("label")).agg(F.count(F.lit(1)).alias("c"), F.min("ord").alias("first"))
    return _modal_from(counts.agg(F.sum("c").alias("n"), _modal_label().alias("top")))


def _label_row() -> Column:
    """A label (label, c, first) as a value whose greatest is the modal one: by count, then by the
    first position seen; labels that no positioned record has come after those."""
    return F.struct("c", (-F.col("first")).alias("before"), "label")


def _modal_label() -> Column:
    return F.max(_label_row())


def _modal_from(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("top").isNotNull()).select(
        F.col("top.label").alias("top_severity"),
        F.col("top.c").alias("top_severity_count"),
        round_stat(pct(F.col("top.c"), F.col("n"))).alias("top_severity_pct"),
    )


# R5, R10, R11 ---------------------------------------------------------------
def _best_first() -> list[Column]:
    return [_score("composite_score").desc(), F.col("ord").asc()]


def top_records(scored: DataFrame, k: int) -> DataFrame:
    """The k best records by composite (missing = 0), earlier ``ord`` first on ties."""
    return scored.orderBy(*_best_first()).limit(k)


def ranked_top(scored: DataFrame, k: int) -> DataFrame:
    """``top_records`` with its 1-based ``rank`` (a window over k rows only)."""
    rank = F.row_number().over(Window.orderBy(*_best_first()))
    return top_records(scored, k).withColumn("rank", rank.cast("long"))


def _top20_stats_from(ranked: DataFrame, k: int = K.TOP_TABLE_ROWS) -> DataFrame:
    top = ranked.filter(F.col("rank") <= k)
    n = F.count(F.lit(1))
    return top.agg(
        round_stat(F.coalesce(F.avg(_score("composite_score")), F.lit(0.0))).alias("top20_avg"),
        round_stat(pct(F.count_if(F.col("source") == F.lit(K.SOURCE_PRIMARY)), n)).alias("top20_nvd_pct"),
    )


def top20_stats(scored: DataFrame, k: int = K.TOP_TABLE_ROWS) -> DataFrame:
    return _top20_stats_from(ranked_top(scored, k), k)


def _fmt(col: Column) -> Column:
    return F.when(col.isNull(), F.lit(K.MISSING_MARK)).otherwise(F.format_string("%.3f", col))


def _top20_table_from(ranked: DataFrame, k: int = K.TOP_TABLE_ROWS) -> DataFrame:
    sev = F.col("severity")
    return ranked.filter(F.col("rank") <= k).select(
        "rank",
        F.coalesce(F.col("cve_id"), F.lit("")).alias("cve_id"),
        F.when(F.coalesce(sev, F.lit("")) == F.lit(""), F.lit(K.MISSING_MARK)).otherwise(sev).alias("severity"),
        _fmt(F.col("cvss_score")).alias("cvss"),
        _fmt(F.col("composite_score")).alias("composite"),
        _fmt(F.col("relevance_score")).alias("relevance"),
        _fmt(F.col("completeness_score")).alias("completeness"),
        _fmt(F.col("clarity_score")).alias("clarity"),
        F.when(_ready(), F.lit("Yes")).otherwise(F.lit("No")).alias("training_ready"),
    )


def top20_table(scored: DataFrame, k: int = K.TOP_TABLE_ROWS) -> DataFrame:
    """Display rows of the top-k table (numbers as 3-decimal text, '—' for missing)."""
    return _top20_table_from(ranked_top(scored, k), k)


def _heatmap_from(ranked: DataFrame, k: int = K.HEATMAP_ROWS) -> DataFrame:
    wide = ranked.filter(F.col("rank") <= k).select(
        "rank",
        F.coalesce(F.col("cve_id"), F.lit("")).alias("cve_id"),
        *[_score(d).alias(d) for d in K.DIMENSIONS],
    )
    return wide.unpivot(["rank", "cve_id"], list(K.DIMENSIONS), "dimension", "score")


def heatmap(scored: DataFrame, k: int = K.HEATMAP_ROWS) -> DataFrame:
    """Top-k records × four dimensions, long format ``(rank, cve_id, dimension, score)``."""
    return _heatmap_from(ranked_top(scored, k), k)


# R6 -------------------------------------------------------------------------
_BANDS = ("Training Ready", "Review Queue", "Rejected")


@per_session
def _readiness_aggs(cfg: CurationConfig) -> list[Column]:
    c = _score("composite_score")
    hi, lo = F.lit(cfg.quality_threshold), F.lit(cfg.review_floor)
    real = ~F.isnan(c)  # NaN compares false with every bound: it is in no band
    conds = (real & (c >= hi), real & (c >= lo) & (c < hi), real & (c < lo))
    return [F.count_if(cond).alias(f"band_{i}") for i, cond in enumerate(conds)]


def _readiness_from(g: DataFrame) -> DataFrame:
    return g.select(_readiness_rows())


@per_session
def _readiness_rows() -> Column:
    total = F.col("band_0") + F.col("band_1") + F.col("band_2")
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(name).alias("bucket"),
            F.col(f"band_{i}").cast("long").alias("count"),
            round_stat(pct(F.col(f"band_{i}"), total)).alias("pct"),
        )
        for i, name in enumerate(_BANDS)
    ]
    return F.inline(F.array(*rows))


def readiness_breakdown(scored: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """Records per composite band over all scored rows: count and share."""
    return _readiness_from(scored.agg(*_readiness_aggs(cfg)))


# R7 -------------------------------------------------------------------------
@per_session
def _histogram_aggs() -> list[Column]:
    """One conditional count per bin: every bin exists (empty ones count 0),
    out-of-range scores land in none, and no join is needed."""
    c = _score("composite_score")
    # NaN or infinite scores fall in no bin (and are not cast to a number).
    finite = ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    grid = F.when(finite, F.round(c * 10000)).cast("long")
    step = round(K.HISTOGRAM_WIDTH * 10000)
    bin_no = F.floor(grid / step)
    return [F.count_if(bin_no == i).alias(f"hist_{i}") for i in range(K.HISTOGRAM_BINS)]


def _histogram_from(g: DataFrame) -> DataFrame:
    return g.select(_histogram_rows())


@per_session
def _histogram_rows() -> Column:
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("bin"),
            F.lit(round(i * K.HISTOGRAM_WIDTH, 2)).alias("bin_start"),
            F.lit(round((i + 1) * K.HISTOGRAM_WIDTH, 2)).alias("bin_end"),
            F.col(f"hist_{i}").cast("long").alias("count"),
        )
        for i in range(K.HISTOGRAM_BINS)
    ]
    return F.inline(F.array(*rows))


def score_histogram(scored: DataFrame) -> DataFrame:
    """21 bins of width 0.05 from 0 (the last one [1.00, 1.05)), zero-filled.

    The bin comes from the score on its 4-decimal grid, so a composite of
    exactly 0.60 lands in [0.60, 0.65) and not, by binary rounding, below.
    """
    return _histogram_from(scored.agg(*_histogram_aggs()))


# R8 -------------------------------------------------------------------------
@per_session
def _dimension_aggs() -> list[Column]:
    out = []
    for i, d in enumerate(K.DIMENSIONS):
        v = _score(d)
        out += [
            F.min(v).alias(f"dim{i}_min"),
            F.max(v).alias(f"dim{i}_max"),
            F.avg(v).alias(f"dim{i}_mean"),
        ]
    return out


def _dimension_from(g: DataFrame, stats: OrderStats) -> DataFrame:
    rows = []
    for i, d in enumerate(K.DIMENSIONS):
        q = [_known(x) for x in stats.quartiles.get(d, [None] * 3)]
        rows.append(
            F.struct(
                F.lit(d).alias("dimension"),
                round_stat(F.col(f"dim{i}_min")).alias("min"),
                round_stat(q[0]).alias("q1"),
                round_stat(q[1]).alias("median"),
                round_stat(q[2]).alias("q3"),
                round_stat(F.col(f"dim{i}_max")).alias("max"),
                round_stat(F.col(f"dim{i}_mean")).alias("mean"),
            )
        )
    return g.select(F.inline(F.array(*rows)))


def dimension_summary(scored: DataFrame) -> DataFrame:
    """Per dimension: min, quartiles (linear interpolation), max and mean."""
    return _dimension_from(scored.agg(*_dimension_aggs()), order_stats(scored, quartiles=True))


# R9 -------------------------------------------------------------------------
@per_session
def _severity_aggs() -> list[Column]:
    label = severity_group_expr()
    known = K.SEVERITY_ORDER[:-1]
    bucket = F.when(label.isin(*known), label).otherwise(F.lit(K.UNKNOWN_SEVERITY))
    return [F.count_if(bucket == F.lit(s)).alias(f"sev_{i}") for i, s in enumerate(K.SEVERITY_ORDER)]


def _severity_from(g: DataFrame) -> DataFrame:
    return g.select(_severity_rows())


@per_session
def _severity_rows() -> Column:
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(s).alias("severity"),
            F.col(f"sev_{i}").cast("long").alias("count"),
        )
        for i, s in enumerate(K.SEVERITY_ORDER)
    ]
    return F.inline(F.array(*rows))


def severity_distribution(scored: DataFrame) -> DataFrame:
    """Records per fixed severity bucket (any other label counts as UNKNOWN)."""
    return _severity_from(scored.agg(*_severity_aggs()))


# R12 ------------------------------------------------------------------------
def _callout_from(totals: DataFrame, stats: OrderStats, modal: tuple[Column, Column], top: tuple[Column, Column], cfg: CurationConfig) -> DataFrame:
    """The figures as one row of ``totals`` (n_total, n_ready): ``modal`` is label and share,
    ``top`` the two figures of the top 20."""
    med = round_stat(_known(stats.median))
    q1, q3 = stats.hinges or (None, None)
    return totals.select(
        round_stat(pct(F.col("n_ready"), F.coalesce("n_total", F.lit(0)))).alias("pass_rate"),
        med.alias("median_score"),
        F.when(med < F.lit(cfg.quality_threshold), F.lit("below")).otherwise(F.lit("above")).alias("median_position"),
        round_stat(_known(q3) - _known(q1)).alias("credibility_iqr"),
        modal[0].alias("top_severity"),
        modal[1].alias("top_severity_pct"),
        top[0].alias("top20_avg"),
        top[1].alias("top20_nvd_pct"),
    )


def callout_facts(scored: DataFrame, cfg: CurationConfig = DEFAULT_CONFIG) -> DataFrame:
    """The report's key figures as one row.

    One pass counts the records by readiness and by severity label; another is the
    top 20, a single subquery. Median and hinges come from ``order_stats`` before.
    """
    facts = scored.select(_ready().alias("ready"), severity_group_expr().alias("label"), "ord")
    counted = facts.groupingSets([["ready"], ["label"]], "ready", "label").agg(
        F.count(F.lit(1)).alias("c"), F.min("ord").alias("first"), F.grouping("ready").alias("g_ready"), F.grouping("label").alias("g_label"),
    )
    by_ready, by_label = F.col("g_ready") == 0, F.col("g_label") == 0
    totals = counted.agg(
        F.sum(F.when(by_ready, F.col("c"))).alias("n_total"),
        F.coalesce(F.sum(F.when(by_ready & F.col("ready"), F.col("c"))), F.lit(0)).alias("n_ready"),
        F.max(F.when(by_label, _label_row())).alias("top"),
    )
    top = top20_stats(scored).select(F.struct("top20_avg", "top20_nvd_pct").alias("t")).scalar()
    share = F.when(F.col("top").isNotNull(), round_stat(pct(F.col("top.c"), F.col("n_total"))))
    stats = order_stats(scored, median=True, hinges=True)
    return _callout_from(totals.withColumn("t", top), stats, (F.col("top.label"), share), (F.col("t.top20_avg"), F.col("t.top20_nvd_pct")), cfg)


# R13 ------------------------------------------------------------------------
REPORT_COLUMNS = (
    "ord", "cve_id", "severity", "source", "cvss_score", *K.SCORE_COLUMNS, "training_ready",
)


def build_report(
    scored: DataFrame,
    cfg: CurationConfig = DEFAULT_CONFIG,
    materialise: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All report tables, keyed by name.

    One aggregation computes every global statistic (headline, readiness bands,
    histogram, severity buckets, dimension summaries); the top 50 (the top 20 are
    its first rows) and the severity label counts are one pass each, and all medians,
    quartiles and hinges share the passes of ``order_stats`` (two on up to 20,000 records).
    ``materialise`` (for example a reliable checkpoint) is applied to the three small
    results so that the tables derived from them do not re-read the records.
    """
    narrow = scored.select(*REPORT_COLUMNS)
    g = narrow.agg(*_headline_aggs(), *_readiness_aggs(cfg), *_histogram_aggs(), *_severity_aggs(), *_dimension_aggs())
    top = ranked_top(narrow, max(K.HEATMAP_ROWS, K.TOP_TABLE_ROWS))
    modal = modal_severity(narrow)
    if materialise is not None:
        g, top, modal = (materialise(x) for x in (g, top, modal))
    stats = order_stats(narrow, median=True, hinges=True, quartiles=True)
    top20 = _top20_stats_from(top)
    mode = tuple(modal.select(c).scalar() for c in ("top_severity", "top_severity_pct"))
    best = tuple(top20.select(c).scalar() for c in ("top20_avg", "top20_nvd_pct"))
    return {
        "headline_stats": _headline_from(g),
        "median_score": _median_from(g, stats),
        "credibility_iqr": _hinges_from(g, stats),
        "modal_severity": modal,
        "top20_stats": top20,
        "readiness_breakdown": _readiness_from(g),
        "score_histogram": _histogram_from(g),
        "dimension_summary": _dimension_from(g, stats),
        "severity_distribution": _severity_from(g),
        "top20_table": _top20_table_from(top),
        "heatmap": _heatmap_from(top),
        "callout_facts": _callout_from(g, stats, mode, best, cfg),
    }
