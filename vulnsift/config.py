"""Parameters of a curation run and the fixed values the results depend on."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for the results to match:
# keyword list (in scoring order), placeholder markers, exclusion reason texts,
# severity order, source names, catch-all weakness codes and pipeline version.
# ---------------------------------------------------------------------------
SECURITY_KEYWORDS: tuple[str, ...] = (
    "exploit",
    "vulnerability",
    "injection",
    "overflow",
    "bypass",
    "authentication",
    "privilege",
    "remote code execution",
    "xss",
    "sqli",
    "rce",
    "buffer overflow",
    "use-after-free",
)
KEYWORD_CAP = 3
KEYWORD_POINTS = 0.1

PLACEHOLDER_MARKERS: tuple[str, ...] = ("** RESERVED **", "** REJECT **")

REASON_CLARITY = "clarity_score=0.0 (placeholder or unparseable description)"
REASON_BLANK = "description missing or empty"
REASON_UNTRUSTED = "source_credibility_score < 0.3 (untrusted source)"
REASON_SEPARATOR = "; "

SEVERITY_ORDER: tuple[str, ...] = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "UNKNOWN")
UNKNOWN_SEVERITY = "UNKNOWN"

SOURCE_PRIMARY = "nvd"
SOURCE_MIRROR = "huggingface"
WEAKNESS_PLACEHOLDERS: tuple[str, ...] = ("NVD-CWE-Other", "NVD-CWE-noinfo")
CWE_PREFIX = "CWE-"
ENGLISH_TAGS: tuple[str, ...] = ("en", "en-us")

TIER_READY = "training_ready"
TIER_REVIEW = "review_queue"
TIER_REJECTED = "rejected"

ROUTE_FINAL = "training_final"
ROUTE_REVIEW = "review_queue"
ROUTE_REJECTED = "rejected"
ROUTE_FLAGGED = "flagged_contamination"
ROUTES: tuple[str, ...] = (ROUTE_FINAL, ROUTE_REVIEW, ROUTE_REJECTED, ROUTE_FLAGGED)

PIPELINE_VERSION = "v0.1.0"

# Credibility bases and the CVSS boost.
CREDIBILITY_PRIMARY = 1.0
CREDIBILITY_MIRROR = 0.6
CREDIBILITY_OTHER = 0.3
CREDIBILITY_CVSS_BOOST = 0.1
CREDIBILITY_FLOOR = 0.3  # hard exclusion below this

# Relevance points.
CVSS_HIGH, CVSS_HIGH_POINTS = 7.0, 0.4
CVSS_MEDIUM, CVSS_MEDIUM_POINTS = 4.0, 0.2
CWE_POINTS = 0.3

# Completeness points, in the order they are added.
COMPLETE_DESCRIPTION = 0.4
COMPLETE_CVSS = 0.2
COMPLETE_SEVERITY = 0.1
COMPLETE_CWE = 0.2
COMPLETE_PUBLISHED = 0.1

# Clarity bands: (low, high, value), inclusive, first match wins; else 0.0.
CLARITY_BANDS: tuple[tuple[int, int, float], ...] = (
    (100, 1000, 1.0),
    (50, 99, 0.7),
    (1001, 2000, 0.7),
    (2001, 5000, 0.4),
)

# Report: histogram bins start at 0 with width 0.05; 21 bins up to 1.05.
HISTOGRAM_WIDTH = 0.05
HISTOGRAM_BINS = 21
TOP_TABLE_ROWS = 20
HEATMAP_ROWS = 50
MISSING_MARK = "—"  # em dash shown for a missing value in the top-20 table

DIMENSIONS: tuple[str, ...] = (
    "relevance_score",
    "completeness_score",
    "source_credibility_score",
    "clarity_score",
)
SCORE_COLUMNS: tuple[str, ...] = DIMENSIONS + ("composite_score",)


@dataclass(frozen=True)
class CurationConfig:
    """All tunables of a run (weights, thresholds, bounds, quota, cutoff)."""

    weight_relevance: float = 0.35
    weight_completeness: float = 0.25
    weight_credibility: float = 0.25
    weight_clarity: float = 0.15
    quality_threshold: float = 0.60
    review_floor: float = 0.40
    min_description_length: int = 50
    max_description_length: int = 5000
    per_severity_quota: int = 50
    cutoff_date: str = "2024-08-01"
    pipeline_version: str = PIPELINE_VERSION

    def __post_init__(self) -> None:
        total = (
            self.weight_relevance
            + self.weight_completeness
            + self.weight_credibility
            + self.weight_clarity
        )
        if not math.isclose(total, 1.0, abs_tol=1e-9):
            raise ValueError(f"scoring weights must sum to 1.0, got {total}")
        if not 0 <= self.review_floor <= self.quality_threshold:
            raise ValueError("review_floor must lie between 0 and quality_threshold")
        if self.min_description_length > self.max_description_length:
            raise ValueError("min_description_length exceeds max_description_length")
        if self.per_severity_quota < 0:
            raise ValueError("per_severity_quota must be >= 0")
        date.fromisoformat(self.cutoff_date)  # raises on a malformed cutoff


DEFAULT_CONFIG = CurationConfig()
