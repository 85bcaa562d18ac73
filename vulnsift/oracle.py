"""DuckDB SQL restating each registered query, for the correctness gate.

Each string runs on the pre-registered parquet views (``documents`` etc.) and
produces the same columns as the Spark query of the same name. The SQL is an
independent statement of the semantics; only the derived input relation
(``vulnsift.sources.fixture``) is shared text. DOUBLE literals are spelled
out because DuckDB reads ``0.1`` as DECIMAL.
"""

from __future__ import annotations

from vulnsift import config as K
from vulnsift.schemas import REPORT_TABLES
from vulnsift.sources.fixture import PAGE_SIZE, cve_relation_sql, date_texts_sql

CFG = K.DEFAULT_CONFIG


def d(x: float) -> str:
    """A DOUBLE literal."""
    return f"CAST({x!r} AS DOUBLE)"


def q(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def blank_sql(expr: str) -> str:
    return f"regexp_matches(coalesce({expr}, ''), '^{WS}*$')"


def date_sql(expr: str) -> str:
    """Lenient date parse; returns a DATE or NULL."""
    y, m = "([0-9]{4})", "(1[0-2]|0[1-9]|[1-9])"
    dd = "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
    t = "[Tt](?:2[0-3]|[01][0-9]|[0-9]):(?:[0-5][0-9]|[0-9]):(?:[0-5][0-9]|[0-9])"
    fmts = [
        (22, f"^{y}-{m}-{dd}{t}\\.(?:[0-9]{{1,6}})$", 3),
        (19, f"^{y}-{m}-{dd}{t}$", 3),
        (10, f"^{y}-{m}-{dd}$", 3),
        (7, f"^{y}-{m}$", 2),
        (4, f"^{y}$", 1),
    ]
    s = strip_sql(f"coalesce({expr}, '')")
    parts = []
    for n, pat, groups in fmts:
        p = strip_sql(f"substr({s}, 1, {n})")
        yy = f"regexp_extract({p}, '{pat}', 1)"
        mm = f"lpad(regexp_extract({p}, '{pat}', 2), 2, '0')" if groups >= 2 else "'01'"
        dy = f"lpad(trim(regexp_extract({p}, '{pat}', 3)), 2, '0')" if groups >= 3 else "'01'"
        parts.append(
            f"CASE WHEN regexp_matches({p}, '{pat}') AND {yy} <> '0000' "
            f"THEN TRY_CAST(concat({yy}, '-', {mm}, '-', {dy}) AS DATE) END"
        )
    return "coalesce(" + ",\n    ".join(parts) + ")"


def keyword_hits_sql(desc: str) -> str:
    terms = " + ".join(
        f"CASE WHEN contains(lower({desc}), {q(k)}) THEN 1 ELSE 0 END" for k in K.SECURITY_KEYWORDS
    )
    return f"least({terms}, {K.KEYWORD_CAP})"


def cve_cte() -> str:
    return f"cve AS ({cve_relation_sql()})"


def dims_cte(src: str = "cve") -> str:
    """Per-record base facts and the four ungated dimensions (unrounded)."""
    lo, hi = CFG.min_description_length, CFG.max_description_length
    return f"""base AS (
  SELECT *, coalesce(description, '') AS d, length(coalesce(description, '')) AS n,
         {keyword_hits_sql("coalesce(description, '')")} AS hits
  FROM {src}
), dims AS (
  SELECT *,
    least({d(0.0)}
      + CASE WHEN cvss_score IS NOT NULL AND NOT isnan(cvss_score) AND cvss_score >= {d(7.0)} THEN {d(0.4)}
             WHEN cvss_score IS NOT NULL AND NOT isnan(cvss_score) AND cvss_score >= {d(4.0)} THEN {d(0.2)}
             ELSE {d(0.0)} END
      + CASE WHEN cwe_id IS NOT NULL THEN {d(0.3)} ELSE {d(0.0)} END
      + CAST(hits AS DOUBLE) * {d(0.1)}, {d(1.0)}) AS rel,
    least({d(0.0)}
      + CASE WHEN d <> '' AND n BETWEEN {lo} AND {hi} THEN {d(0.4)} ELSE {d(0.0)} END
      + CASE WHEN cvss_score IS NOT NULL THEN {d(0.2)} ELSE {d(0.0)} END
      + CASE WHEN coalesce(severity, '') <> '' THEN {d(0.1)} ELSE {d(0.0)} END
      + CASE WHEN cwe_id IS NOT NULL THEN {d(0.2)} ELSE {d(0.0)} END
      + CASE WHEN coalesce(published, '') <> '' THEN {d(0.1)} ELSE {d(0.0)} END, {d(1.0)}) AS comp,
    least(CASE lower(coalesce(source, '')) WHEN 'nvd' THEN {d(1.0)} WHEN 'huggingface' THEN {d(0.6)} ELSE {d(0.3)} END
      + CASE WHEN cvss_score IS NOT NULL THEN {d(0.1)} ELSE {d(0.0)} END, {d(1.0)}) AS cred,
    CASE WHEN contains(d, '** RESERVED **') OR contains(d, '** REJECT **') THEN {d(0.0)}
         WHEN n BETWEEN 100 AND 1000 THEN {d(1.0)}
         WHEN n BETWEEN 50 AND 99 OR n BETWEEN 1001 AND 2000 THEN {d(0.7)}
         WHEN n BETWEEN 2001 AND 5000 THEN {d(0.4)}
         ELSE {d(0.0)} END AS clar,
    (d = '' OR NOT (n BETWEEN {lo} AND {hi})) AS gate_failed
  FROM base
)"""


def scored_cte() -> str:
    """Gated, rounded scores with composite and readiness (after ``dims``)."""
    thr = CFG.quality_threshold
    w = (CFG.weight_relevance, CFG.weight_completeness, CFG.weight_credibility, CFG.weight_clarity)
    return f"""scored AS (
  SELECT ord, cve_id, description, published, cvss_score, severity, cwe_id, source,
    CASE WHEN gate_failed THEN {d(0.0)} ELSE round(rel, 4) END AS relevance_score,
    CASE WHEN gate_failed THEN {d(0.0)} ELSE round(comp, 4) END AS completeness_score,
    CASE WHEN gate_failed THEN {d(0.0)} ELSE round(cred, 4) END AS source_credibility_score,
    CASE WHEN gate_failed THEN {d(0.0)} ELSE round(clar, 4) END AS clarity_score,
    CASE WHEN gate_failed THEN {d(0.0)} ELSE round(least(greatest(
        {d(w[0])} * rel + {d(w[1])} * comp + {d(w[2])} * cred + {d(w[3])} * clar, {d(0.0)}), {d(1.0)}), 4) END AS composite_score
  FROM dims
), scored_flag AS (
  SELECT *, (composite_score >= {d(thr)} AND composite_score IS NOT NULL) AS ready_raw FROM scored
)"""


def scoring_prefix() -> str:
    """``WITH`` clause producing ``ready`` = scored records with ``training_ready``."""
    return (
        f"WITH {cve_cte()}, {dims_cte()}, {scored_cte()}, ready AS ("
        f"SELECT * EXCLUDE (ready_raw), ready_raw AS training_ready FROM scored_flag)"
    )


def _standalone(expr: str, name: str) -> str:
    return f"WITH {cve_cte()}, {dims_cte()} SELECT ord, cve_id, round({expr}, 4) AS {name} FROM dims"


def primary_sql(source: str) -> str:
    """The primary records as the pages give them; ``ord`` counts on each page."""
    return f"""SELECT (ord // {PAGE_SIZE}) * {PAGE_SIZE} + row_number() OVER (PARTITION BY ord // {PAGE_SIZE} ORDER BY ord) - 1 AS ord, cve_id,
  CASE WHEN description IS NULL OR ord % 17 = 5 THEN '' ELSE description END AS description,
  published,
  concat('2025-02-', lpad(CAST(ord % 28 + 1 AS VARCHAR), 2, '0')) AS last_modified,
  CASE WHEN cvss_score IS NULL OR ord % 4 = 3 THEN NULL ELSE cvss_score END AS cvss_score,
  CASE WHEN cvss_score IS NULL OR ord % 4 = 3 THEN NULL ELSE severity END AS severity,
  CASE WHEN cwe_id IS NULL THEN '' WHEN ord % 5 = 0 THEN concat(cwe_id, ',', cwe_id) ELSE cwe_id END AS cwe_ids,
  CAST(CASE WHEN cwe_id IS NULL THEN 0 WHEN ord % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_cwe,
  'nvd' AS source, ord // {PAGE_SIZE} AS page
FROM {source}"""


MIRROR_TEXT_SCORE = f"""CASE WHEN ord % 5 = 4 THEN NULL WHEN cvss_score IS NOT NULL THEN cvss_score
       WHEN ord % 5 = 0 THEN {d(9.9)} WHEN ord % 5 = 1 THEN {d(1.0)} ELSE NULL END"""
MIRROR_NUMBER_SCORE = f"""CASE ord % 4 WHEN 0 THEN coalesce(nullif(cvss_score, {d(0.0)}), {d(9.9)})
       WHEN 1 THEN coalesce(nullif(cvss_score, {d(0.0)}), {d(5.0)}) WHEN 2 THEN cvss_score END"""


def mirror_sql(source: str, score: str = MIRROR_TEXT_SCORE) -> str:
    """The mirror records as the rows give them."""
    return f"""SELECT ord, cid AS cve_id, coalesce(description, 'None') AS description,
  CASE WHEN starts_with(cid, 'CVE-') AND regexp_matches(split_part(cid, '-', 2), '^[0-9]+$')
       THEN split_part(cid, '-', 2) ELSE '' END AS published,
  '' AS last_modified,
  {score} AS cvss_score,
  upper(nullif(sev, '')) AS severity,
  coalesce(cwe, '') AS cwe_ids,
  CAST(CASE WHEN cwe IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_cwe,
  'huggingface' AS source
FROM (
  SELECT *, CASE WHEN ord % 13 = 7 THEN lower(cve_id) ELSE cve_id END AS cid,
         CASE WHEN ord % 2 = 1 THEN lower(severity) ELSE severity END AS sev,
         CASE WHEN cwe_id IS NOT NULL AND ord % 7 = 3 THEN 'Improper Input Validation' ELSE cwe_id END AS cwe
  FROM {source}
) WHERE cid <> ''"""


RECORD = """cve_id, description, published, '' AS last_modified, cvss_score, severity, coalesce(cwe_id, '') AS cwe_ids,
  CAST(CASE WHEN cwe_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_cwe, source"""
# Post-cutoff publication texts of the derived relation, known without parsing.
AFTER_CUTOFF = "coalesce(published IN ('2025', '2024-08-02T00:15:08.410', '2024-09'), false)"


def filter_ctes() -> str:
    """After ``ready``: ``cls`` (reasons), ``tiered``, ``sample`` (with flag)."""
    thr, floor, k = CFG.quality_threshold, CFG.review_floor, CFG.per_severity_quota
    ranks = " ".join(f"WHEN {q(name)} THEN {i}" for i, name in enumerate(K.SEVERITY_ORDER))
    five = ", ".join(q(x) for x in K.SEVERITY_ORDER)
    return f"""cls AS (
  SELECT *, nullif(concat_ws('; ',
      CASE WHEN coalesce(clarity_score, {d(1.0)}) = {d(0.0)} THEN {q(K.REASON_CLARITY)} END,
      CASE WHEN {blank_sql("description")} THEN {q(K.REASON_BLANK)} END,
      CASE WHEN coalesce(source_credibility_score, {d(1.0)}) < {d(0.3)} THEN {q(K.REASON_UNTRUSTED)} END), '') AS exclusion_reason
  FROM ready
), tiered AS (
  SELECT *, CASE WHEN exclusion_reason IS NOT NULL THEN NULL
                 WHEN coalesce(composite_score, {d(0.0)}) >= {d(thr)} THEN 'training_ready'
                 WHEN coalesce(composite_score, {d(0.0)}) >= {d(floor)} THEN 'review_queue'
                 ELSE 'rejected' END AS tier
  FROM cls
), grp AS (
  SELECT *, upper(coalesce(nullif(severity, ''), 'UNKNOWN')) AS sev_group FROM tiered WHERE tier = 'training_ready'
), ranked AS (
  SELECT *, CAST(CASE sev_group {ranks} END AS BIGINT) AS severity_rank,
         row_number() OVER (PARTITION BY sev_group ORDER BY coalesce(composite_score, {d(0.0)}) DESC, ord) AS sample_rank
  FROM grp WHERE sev_group IN ({five})
), sample AS (
  SELECT *, {AFTER_CUTOFF} AS contamination_flag
  FROM ranked WHERE sample_rank <= {k}
)"""


def filtering_prefix() -> str:
    return f"{scoring_prefix()}, {filter_ctes()}"


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``.

    DuckDB's ``count_if`` returns HUGEINT; Spark's returns BIGINT.
    """
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j : k + 1] + " AS BIGINT)")
        i = k + 1


def report_sql(o: dict[str, str]) -> str:
    """Every value of the twelve report tables, a row for each."""
    tables, values = [], []
    for name, (keys, texts, numbers) in REPORT_TABLES.items():
        tables.append(f"{name} AS MATERIALIZED ({o[name]})")
        row = " || '/' || ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) or "''"
        for c in (*texts, *numbers):
            text, number = (f'"{c}"', "CAST(NULL AS DOUBLE)") if c in texts else ("CAST(NULL AS VARCHAR)", f'CAST("{c}" AS DOUBLE)')
            values.append(f"SELECT '{name}' AS report_table, {row} AS row, '{c}' AS field, {text} AS text, {number} AS number FROM {name}")
    return f"WITH {', '.join(tables)}\n" + "\nUNION ALL ".join(values)


def oracles() -> dict[str, str]:
    return {name: _bigint_counts(sql) for name, sql in _oracles().items()}


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    cve = f"WITH {cve_cte()}"

    o["nvd_normalise"] = f"""{cve}, p AS ({primary_sql('cve')})
SELECT * EXCLUDE (page) FROM p UNION ALL SELECT * EXCLUDE (page) FROM p WHERE page % 5 = 3"""

    o["hf_normalise"] = f"""{cve}
SELECT 'text' AS "columns", * FROM ({mirror_sql('cve')})
UNION ALL SELECT 'numbers', * FROM ({mirror_sql('cve', MIRROR_NUMBER_SCORE)})"""

    o["source_anti_join"] = f"""{cve}
SELECT ord, {RECORD} FROM cve m
WHERE source <> 'nvd' AND cve_id <> ''
  AND NOT EXISTS (SELECT 1 FROM cve p WHERE p.source = 'nvd' AND p.cve_id = m.cve_id)"""

    o["merge_dedup"] = f"""{cve}
SELECT CAST(CASE WHEN source = 'nvd' THEN 0 ELSE 1 END AS INTEGER) AS src_rank,
  CASE WHEN ord % 20 <> 4 AND ord % 10 <> 7 THEN ord END AS ord, {RECORD}
FROM cve WHERE cve_id <> ''
QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY source <> 'nvd', ord % 20 = 4 OR ord % 10 = 7, ord) = 1"""

    merged = f"""{cve}, p AS ({primary_sql("(SELECT * FROM cve WHERE source = 'nvd')")}),
m AS ({mirror_sql("(SELECT * FROM cve WHERE source <> 'nvd')")}),
u AS (SELECT CAST(0 AS INTEGER) AS src_rank, * EXCLUDE (page) FROM p UNION ALL SELECT CAST(1 AS INTEGER), * FROM m),
merged AS (SELECT * FROM u WHERE cve_id <> '' QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY src_rank, ord) = 1)"""
    o["ingest_records"] = f"{merged} SELECT * EXCLUDE (ord) FROM merged"
    # Every fourth page and some rows of the Parquet mirror have no position: they follow the
    # others. An empty text in CSV is a missing one.
    order = "src_rank, late, ord"
    o["ingest_files"] = f"""{cve}, p AS ({primary_sql("(SELECT * FROM cve WHERE source = 'nvd')")}),
m AS ({mirror_sql("(SELECT * FROM cve WHERE source <> 'nvd')")}),
u AS (
  SELECT f.mirror_format, 0 AS src_rank, p.page % 4 = 1 AS late, p.* EXCLUDE (page) FROM p, (VALUES ('csv-multiline'), ('parquet')) AS f(mirror_format)
  UNION ALL SELECT 'csv-multiline', 1, false, m.* REPLACE (CASE WHEN description = '' THEN 'None' ELSE description END AS description) FROM m
  UNION ALL SELECT 'parquet', 1, ord % 20 = 4 OR ord % 10 = 7, m.* FROM m
), kept AS (SELECT * FROM u WHERE cve_id <> '' QUALIFY row_number() OVER (PARTITION BY mirror_format, cve_id ORDER BY {order}) = 1)
SELECT * EXCLUDE (src_rank, late, ord), row_number() OVER (PARTITION BY mirror_format ORDER BY {order}) - 1 AS ord FROM kept"""
    o["ingest_counts"] = f"""{merged}
SELECT count(*) AS total, count_if(source = 'nvd') AS nvd, count_if(source = 'huggingface') AS huggingface FROM merged"""

    for name, expr in (("relevance", "rel"), ("completeness", "comp"), ("credibility", "cred"), ("clarity", "clar")):
        col = {"relevance": "relevance_score", "completeness": "completeness_score",
               "credibility": "source_credibility_score", "clarity": "clarity_score"}[name]
        o[name] = _standalone(expr, col)
    o["composite"] = (
        f"{scoring_prefix()} SELECT ord, cve_id, relevance_score, completeness_score, "
        f"source_credibility_score, clarity_score, composite_score, training_ready FROM ready"
    )
    o["score_dataset"] = f"""{scoring_prefix()}
SELECT ord, cve_id, description, published, '' AS last_modified, cvss_score, severity,
  coalesce(cwe_id, '') AS cwe_ids, source, relevance_score, completeness_score,
  source_credibility_score, clarity_score, composite_score, training_ready,
  {q(CFG.pipeline_version)} AS pipeline_version, '2025-01-01T00:00:00Z' AS scored_at
FROM ready"""

    fp = filtering_prefix()
    o["hard_exclusions"] = f"{fp} SELECT ord, cve_id, exclusion_reason FROM cls WHERE exclusion_reason IS NOT NULL"
    o["tiers"] = f"{fp} SELECT ord, cve_id, composite_score, tier FROM tiered WHERE exclusion_reason IS NULL"
    o["stratified_sample"] = (
        f"{fp} SELECT ord, cve_id, severity, composite_score, severity_rank, "
        f"CAST(sample_rank AS BIGINT) AS sample_rank, true AS sampled FROM sample"
    )
    o["parse_date"] = f"""WITH o AS (SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS d FROM orders)
SELECT o_orderkey AS ord, {date_texts_sql(0)} AS published, {date_texts_sql(1)} AS published_date FROM o"""
    o["decontaminate"] = f"{scoring_prefix()} SELECT ord, cve_id, published, {AFTER_CUTOFF} AS contamination_flag FROM ready"
    o["filter_summary"] = f"""{fp}
SELECT count(*) AS total_input,
  count_if(exclusion_reason IS NOT NULL) AS hard_excluded,
  count_if(tier = 'training_ready') AS training_ready_raw,
  count_if(tier = 'review_queue') AS review_queue,
  count_if(tier = 'rejected') AS tier_rejected,
  (SELECT count(*) FROM sample) AS sampled,
  (SELECT count_if(NOT contamination_flag) FROM sample) AS training_final,
  (SELECT count_if(contamination_flag) FROM sample) AS flagged_contamination
FROM tiered"""
    o["training_final"] = (
        f"{fp} SELECT ord, cve_id, severity, published, composite_score, severity_rank, "
        f"CAST(sample_rank AS BIGINT) AS sample_rank FROM sample WHERE NOT contamination_flag"
    )
    o["routed_outputs"] = f"""{fp}
SELECT CASE WHEN exclusion_reason IS NOT NULL THEN {q(K.ROUTE_REJECTED)} ELSE {q(K.ROUTE_REVIEW)} END AS route,
  ord, cve_id, description, composite_score, exclusion_reason, tier, CAST(NULL AS BOOLEAN) AS sampled,
  CAST(NULL AS BOOLEAN) AS contamination_flag, CAST(NULL AS BIGINT) AS severity_rank, CAST(NULL AS BIGINT) AS sample_rank
FROM tiered WHERE exclusion_reason IS NOT NULL OR tier = 'review_queue'
UNION ALL
SELECT CASE WHEN contamination_flag THEN {q(K.ROUTE_FLAGGED)} ELSE {q(K.ROUTE_FINAL)} END,
  ord, cve_id, description, composite_score, exclusion_reason, tier, true,
  CASE WHEN contamination_flag THEN true END, severity_rank, CAST(sample_rank AS BIGINT)
FROM sample"""
    o["scored_jsonl"] = o["score_dataset"]
    sp = scoring_prefix()
    means = ", ".join(
        f"round(coalesce(avg({c}), {d(0.0)}), 6) AS avg_{c.replace('_score', '').replace('source_', '')}"
        for c in K.SCORE_COLUMNS
    )
    o["score_summary"] = f"""{sp}
SELECT count(*) AS total, count_if(training_ready) AS ready_count,
  round(CASE WHEN count(*) > 0 THEN count_if(training_ready) * {d(100.0)} / count(*) ELSE {d(0.0)} END, 6) AS ready_pct,
  {means}
FROM ready"""
    o["data_card_stats"] = f"""{fp}
SELECT count(*) AS total_records,
  count_if(source = 'nvd') AS nvd_records,
  count_if(source = 'huggingface') AS huggingface_records,
  count_if(exclusion_reason IS NULL) AS passing_hard_filters,
  count_if(training_ready) AS training_ready,
  round(CASE WHEN count(*) > 0 THEN count_if(training_ready) * {d(100.0)} / count(*) ELSE {d(0.0)} END, 6) AS pass_rate,
  {means},
  count_if(cvss_score IS NOT NULL) AS with_cvss,
  count_if(cwe_id IS NOT NULL) AS with_cwe
FROM cls"""
    c0 = f"coalesce(composite_score, {d(0.0)})"
    o["headline_stats"] = f"""{sp}
SELECT count(*) AS total, count_if(training_ready) AS ready_count,
  round(count_if(training_ready) * {d(100.0)} / count(*), 6) AS pass_rate,
  round(avg({c0}), 6) AS avg_composite
FROM ready"""
    o["median_score"] = f"{sp} SELECT round(median({c0}), 6) AS median_score FROM ready"
    cred = f"coalesce(source_credibility_score, {d(0.0)})"
    o["credibility_iqr"] = f"""{sp}, cv AS (
  SELECT {cred} AS v, row_number() OVER (ORDER BY {cred}) AS rn, count(*) OVER () AS n FROM ready
), h AS (
  SELECT median(v) FILTER (WHERE rn <= n // 2) AS q1,
         median(v) FILTER (WHERE rn > (n + 1) // 2) AS q3
  FROM cv
)
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr FROM h"""
    label = "upper(coalesce(nullif(severity, ''), 'UNKNOWN'))"
    o["modal_severity"] = f"""{sp}, g AS (
  SELECT {label} AS top_severity, count(*) AS top_severity_count, min(ord) AS first_ord FROM ready GROUP BY 1
)
SELECT top_severity, top_severity_count,
  round(top_severity_count * {d(100.0)} / (SELECT count(*) FROM ready), 6) AS top_severity_pct
FROM g ORDER BY top_severity_count DESC, first_ord LIMIT 1"""
    top = lambda k: f"(SELECT * FROM ready ORDER BY {c0} DESC, ord LIMIT {k})"
    o["top20_stats"] = f"""{sp}
SELECT round(avg({c0}), 6) AS top20_avg,
  round(count_if(source = 'nvd') * {d(100.0)} / count(*), 6) AS top20_nvd_pct
FROM {top(K.TOP_TABLE_ROWS)} t"""
    thr, floor = CFG.quality_threshold, CFG.review_floor
    o["readiness_breakdown"] = f"""{sp}, b AS (
  SELECT CASE WHEN {c0} >= {d(thr)} THEN 0 WHEN {c0} >= {d(floor)} THEN 1 ELSE 2 END AS position FROM ready
), p AS (SELECT * FROM (VALUES (0, 'Training Ready'), (1, 'Review Queue'), (2, 'Rejected')) v(position, bucket))
SELECT CAST(p.position AS BIGINT) AS position, p.bucket,
  CAST(count(b.position) AS BIGINT) AS count,
  round(count(b.position) * {d(100.0)} / (SELECT count(*) FROM ready), 6) AS pct
FROM p LEFT JOIN b ON b.position = p.position GROUP BY p.position, p.bucket"""
    o["score_histogram"] = f"""{sp}, b AS (
  SELECT CAST(floor(CAST(round({c0} * 10000) AS BIGINT) / 500) AS BIGINT) AS bin FROM ready
), r AS (SELECT range AS bin FROM range({K.HISTOGRAM_BINS}))
SELECT r.bin, round(r.bin * {d(K.HISTOGRAM_WIDTH)}, 2) AS bin_start, round((r.bin + 1) * {d(K.HISTOGRAM_WIDTH)}, 2) AS bin_end,
  CAST(count(b.bin) AS BIGINT) AS count
FROM r LEFT JOIN b ON b.bin = r.bin GROUP BY r.bin"""
    dims_union = " UNION ALL ".join(
        f"SELECT '{dm}' AS dimension, coalesce({dm}, {d(0.0)}) AS score FROM ready" for dm in K.DIMENSIONS
    )
    o["dimension_summary"] = f"""{sp}, l AS ({dims_union})
SELECT dimension, round(min(score), 6) AS min, round(quantile_cont(score, 0.25), 6) AS q1,
  round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.75), 6) AS q3,
  round(max(score), 6) AS max, round(avg(score), 6) AS mean
FROM l GROUP BY dimension"""
    order = ", ".join(f"({i}, {q(x)})" for i, x in enumerate(K.SEVERITY_ORDER))
    o["severity_distribution"] = f"""{sp}, b AS (
  SELECT CASE WHEN {label} IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW') THEN {label} ELSE 'UNKNOWN' END AS severity FROM ready
), p AS (SELECT * FROM (VALUES {order}) v(position, severity))
SELECT CAST(p.position AS BIGINT) AS position, p.severity, CAST(count(b.severity) AS BIGINT) AS count
FROM p LEFT JOIN b ON b.severity = p.severity GROUP BY p.position, p.severity"""
    mark = q(K.MISSING_MARK)
    fmt = lambda c: f"CASE WHEN {c} IS NULL THEN {mark} ELSE printf('%.3f', {c}) END"
    o["top20_table"] = f"""{sp}
SELECT CAST(row_number() OVER (ORDER BY {c0} DESC, ord) AS BIGINT) AS rank,
  coalesce(cve_id, '') AS cve_id,
  CASE WHEN coalesce(severity, '') = '' THEN {mark} ELSE severity END AS severity,
  {fmt('cvss_score')} AS cvss, {fmt('composite_score')} AS composite,
  {fmt('relevance_score')} AS relevance, {fmt('completeness_score')} AS completeness,
  {fmt('clarity_score')} AS clarity,
  CASE WHEN training_ready THEN 'Yes' ELSE 'No' END AS training_ready
FROM {top(K.TOP_TABLE_ROWS)} t"""
    heat_union = " UNION ALL ".join(
        f"SELECT rank, cve_id, '{dm}' AS dimension, coalesce({dm}, {d(0.0)}) AS score FROM t" for dm in K.DIMENSIONS
    )
    o["heatmap"] = f"""{sp}, t AS (
  SELECT CAST(row_number() OVER (ORDER BY {c0} DESC, ord) AS BIGINT) AS rank, coalesce(cve_id, '') AS cve_id, *
  EXCLUDE (cve_id) FROM {top(K.HEATMAP_ROWS)} x
) {heat_union}"""
    o["callout_facts"] = f"""{sp}, cv AS (
  SELECT {cred} AS v, row_number() OVER (ORDER BY {cred}) AS rn, count(*) OVER () AS n FROM ready
), h AS (
  SELECT median(v) FILTER (WHERE rn <= n // 2) AS q1, median(v) FILTER (WHERE rn > (n + 1) // 2) AS q3 FROM cv
), g AS (
  SELECT {label} AS sev, count(*) AS cnt, min(ord) AS first_ord FROM ready GROUP BY 1
), m AS (SELECT sev, cnt FROM g ORDER BY cnt DESC, first_ord LIMIT 1),
t AS {top(K.TOP_TABLE_ROWS)},
med AS (SELECT round(median({c0}), 6) AS median_score FROM ready)
SELECT
  round(count_if(training_ready) * {d(100.0)} / count(*), 6) AS pass_rate,
  (SELECT median_score FROM med) AS median_score,
  CASE WHEN (SELECT median_score FROM med) < {d(thr)} THEN 'below' ELSE 'above' END AS median_position,
  (SELECT round(round(q3, 6) - round(q1, 6), 6) FROM h) AS credibility_iqr,
  (SELECT sev FROM m) AS top_severity,
  (SELECT round(cnt * {d(100.0)} / (SELECT count(*) FROM ready), 6) FROM m) AS top_severity_pct,
  (SELECT round(avg({c0}), 6) FROM t) AS top20_avg,
  (SELECT round(count_if(source = 'nvd') * {d(100.0)} / count(*), 6) FROM t) AS top20_nvd_pct
FROM ready"""
    o["report_run"] = report_sql(o)
    return o
