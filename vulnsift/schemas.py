"""Explicit schemas: no inference pass at read time, nested pruning on landings."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# A normalised record. ``ord`` is the record's position in its source order.
RECORD_FIELDS = (
    _f("ord", L),
    _f("cve_id", S),
    _f("description", S),
    _f("published", S),
    _f("last_modified", S),
    _f("cvss_score", D),
    _f("severity", S),
    _f("cwe_ids", T.ArrayType(S)),
    _f("source", S),
)
RECORD_SCHEMA = T.StructType(list(RECORD_FIELDS))

SCORE_FIELDS = (
    _f("relevance_score", D),
    _f("completeness_score", D),
    _f("source_credibility_score", D),
    _f("clarity_score", D),
    _f("composite_score", D),
    _f("training_ready", B),
    _f("pipeline_version", S),
    _f("scored_at", S),
)
SCORED_SCHEMA = T.StructType(list(RECORD_FIELDS + SCORE_FIELDS))

# Fields a filter route may add.
ROUTE_FIELDS = (
    _f("exclusion_reason", S),
    _f("tier", S),
    _f("sampled", B),
    _f("contamination_flag", B),
    _f("severity_rank", T.IntegerType()),
    _f("sample_rank", T.IntegerType()),
)
ROUTED_SCHEMA = T.StructType(list(RECORD_FIELDS + SCORE_FIELDS + ROUTE_FIELDS))

# One landed page of the primary (nested) feed.
_CVSS_ENTRY = T.ArrayType(T.StructType([_f("cvssData", T.StructType([_f("baseScore", D), _f("baseSeverity", S)]))]))
NVD_CVE = T.StructType(
    [
        _f("id", S),
        _f("published", S),
        _f("lastModified", S),
        _f("metrics", T.StructType([_f("cvssMetricV31", _CVSS_ENTRY), _f("cvssMetricV30", _CVSS_ENTRY)])),
        _f("descriptions", T.ArrayType(T.StructType([_f("lang", S), _f("value", S)]))),
        _f("weaknesses", T.ArrayType(T.StructType([_f("description", T.ArrayType(T.StructType([_f("value", S)])))]))),
    ]
)
NVD_PAGE_SCHEMA = T.StructType(
    [
        _f("startIndex", L),
        _f("resultsPerPage", L),
        _f("totalResults", L),
        _f("vulnerabilities", T.ArrayType(T.StructType([_f("cve", NVD_CVE)]))),
    ]
)

# One row of the flat mirror feed (all text, as landed). ``ord`` is the row's
# position in the mirror's order when the landing carries it.
MIRROR_COLUMNS = ("CVE-ID", "DESCRIPTION", "CVSS-V4", "CVSS-V3", "CVSS-V2", "SEVERITY", "CWE-ID")
MIRROR_SCHEMA = T.StructType([_f("ord", L)] + [_f(c, S) for c in MIRROR_COLUMNS])

# The tables of a report: what tells their rows apart, text columns, number columns.
REPORT_TABLES = {
    "headline_stats": ((), (), ("total", "ready_count", "pass_rate", "avg_composite")),
    "median_score": ((), (), ("median_score",)),
    "credibility_iqr": ((), (), ("q1", "q3", "iqr")),
    "modal_severity": ((), ("top_severity",), ("top_severity_count", "top_severity_pct")),
    "top20_stats": ((), (), ("top20_avg", "top20_nvd_pct")),
    "readiness_breakdown": (("position",), ("bucket",), ("count", "pct")),
    "score_histogram": (("bin",), (), ("bin_start", "bin_end", "count")),
    "dimension_summary": (("dimension",), (), ("min", "q1", "median", "q3", "max", "mean")),
    "severity_distribution": (("position",), ("severity",), ("count",)),
    "top20_table": (("rank",), ("cve_id", "severity", "cvss", "composite", "relevance", "completeness", "clarity", "training_ready"), ()),
    "heatmap": (("rank", "dimension"), ("cve_id",), ("score",)),
    "callout_facts": (
        (), ("median_position", "top_severity"),
        ("pass_rate", "median_score", "credibility_iqr", "top_severity_pct", "top20_avg", "top20_nvd_pct"),
    ),
}
