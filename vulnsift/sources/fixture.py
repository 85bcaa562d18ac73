"""Deterministic vulnerability-record relation derived from the ``documents`` table.

The driver tables carry no vulnerability fields, so the test and benchmark
input is a projection of every ``documents`` row into one record: id,
weakness and source are chosen by rules on ``doc_id``, date, CVSS and severity by
its sum with the length of the text; the description embeds the document text (whole, never cut). The projection
is one narrow ``select`` and grows linearly with the table.

The column expressions below are plain SQL that both Spark and DuckDB accept,
so the same text defines the relation for the Spark queries and for the
DuckDB oracle. ``ord`` (the document id) is the record order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# (column, SQL expression over documents)
CVE_COLUMNS: tuple[tuple[str, str], ...] = (
    ("ord", "doc_id"),
    (
        "cve_id",
        """CASE WHEN doc_id % 50 = 13 THEN ''
       WHEN doc_id % 10 = 1 THEN concat('CVE-', CAST(1999 + (doc_id - 1) % 27 AS STRING), '-', lpad(CAST(doc_id - 1 AS STRING), 6, '0'))
       WHEN doc_id % 20 = 4 THEN concat('CVE-', CAST(1999 + (doc_id - 2) % 27 AS STRING), '-', lpad(CAST(doc_id - 2 AS STRING), 6, '0'))
       ELSE concat('CVE-', CAST(1999 + doc_id % 27 AS STRING), '-', lpad(CAST(doc_id AS STRING), 6, '0')) END""",
    ),
    (
        "description",
        """CASE WHEN doc_id % 25 = 7 THEN ''
       WHEN doc_id % 25 = 3 THEN CAST(NULL AS STRING)
       WHEN doc_id % 25 = 9 THEN repeat(' ', 60)
       WHEN doc_id % 25 = 5 THEN concat('** RESERVED ** ', text)
       WHEN doc_id % 25 = 8 THEN concat('** REJECT ** ', text)
       WHEN doc_id % 25 = 11 THEN concat('Weak resource check in the upload module of ', lang, ' ', source, '.')
       WHEN doc_id % 23 = 6 THEN text
       ELSE concat(CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'SQL injection vulnerability. '
                   WHEN 2 THEN 'Buffer Overflow exploit. ' WHEN 3 THEN 'XSS bypass of authentication. '
                   WHEN 4 THEN 'Resource limit. ' ELSE 'SQLi, use-after-free, privilege, remote code execution. ' END, text)
  END""",
    ),
    (
        "published",
        """CASE (doc_id + length(text)) % 8 WHEN 0 THEN '2023-06-15T10:15:07.123' WHEN 1 THEN '2024' WHEN 2 THEN '2024-08-01'
                  WHEN 3 THEN '2025' WHEN 4 THEN '2024-08-02T00:15:08.410' WHEN 5 THEN ''
                  WHEN 6 THEN '2024-09' ELSE '2024-13-01' END""",
    ),
    (
        "cvss_score",
        """CASE WHEN doc_id % 9 = 4 OR doc_id % 23 = 6 THEN CAST(NULL AS DOUBLE)
       ELSE CAST((doc_id * 37 + length(text)) % 101 AS DOUBLE) / CAST(10 AS DOUBLE) END""",
    ),
    (
        "severity",
        """CASE WHEN doc_id % 9 = 4 OR doc_id % 23 = 6 THEN CAST(NULL AS STRING)
       WHEN doc_id % 31 = 17 THEN 'NONE'
       WHEN doc_id % 31 = 19 THEN ''
       WHEN (doc_id * 37 + length(text)) % 101 >= 90 THEN 'CRITICAL'
       WHEN (doc_id * 37 + length(text)) % 101 >= 70 THEN 'high'
       WHEN (doc_id * 37 + length(text)) % 101 >= 40 THEN 'MEDIUM'
       ELSE 'LOW' END""",
    ),
    (
        "cwe_id",
        """CASE WHEN doc_id % 3 = 0 OR doc_id % 23 = 6 THEN CAST(NULL AS STRING)
       ELSE concat('CWE-', CAST(doc_id % 900 AS STRING)) END""",
    ),
    (
        "source",
        """CASE WHEN doc_id % 14 = 11 OR doc_id % 23 = 6 THEN 'unknown_scraper'
       WHEN doc_id % 2 = 0 THEN 'nvd' ELSE 'huggingface' END""",
    ),
)

# Publication texts of the date-parsing check: an order's date ``d`` written in
# many ways, and what the lenient parser makes of each (null = no date). SQL that
# both engines accept; the second column knows the date, it doesn't parse.
DATE_TEXTS: tuple[tuple[str, str], ...] = (
    ("d", "d"),
    ("substr(d, 1, 4)", "concat(substr(d, 1, 4), '-01-01')"),
    ("substr(d, 1, 7)", "concat(substr(d, 1, 7), '-01')"),
    ("concat(d, 'T10:15:07.123')", "d"),
    ("concat(d, 'T10:15:07Z')", "d"),
    ("concat(d, ' 10:00')", "d"),
    ("concat(substr(d, 1, 4), '-13-01')", "concat(substr(d, 1, 4), '-01-01')"),
    ("concat(substr(d, 1, 4), '-02-30')", "concat(substr(d, 1, 4), '-02-01')"),
    ("replace(d, '-', '')", "concat(substr(d, 1, 4), '-01-01')"),
    ("concat(substr(d, 1, 5), CAST(CAST(substr(d, 6, 2) AS INT) AS STRING), '-', CAST(CAST(substr(d, 9, 2) AS INT) AS STRING))", "d"),
    ("concat(' ', d, ' ')", "d"),
    ("substr(d, 1, 3)", "CAST(NULL AS STRING)"),
    ("concat(substr(d, 1, 4), 'garbage')", "concat(substr(d, 1, 4), '-01-01')"),
    ("concat(substr(d, 1, 8), 'xx')", "concat(substr(d, 1, 7), '-01')"),
    ("''", "CAST(NULL AS STRING)"),
    ("'n/a'", "CAST(NULL AS STRING)"),
    ("CAST(NULL AS STRING)", "CAST(NULL AS STRING)"),
)


def cve_select_sql() -> str:
    """``SELECT`` list of the relation (shared with the SQL oracle)."""
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in CVE_COLUMNS)


def cve_relation_sql(table: str = "documents") -> str:
    return f"SELECT\n  {cve_select_sql()}\nFROM {table}"


def date_texts_sql(column: int, key: str = "o_orderkey") -> str:
    """The text (0) or the expected date (1) of each order, by its key."""
    cases = " ".join(f"WHEN {i} THEN {pair[column]}" for i, pair in enumerate(DATE_TEXTS))
    return f"CASE {key} % {len(DATE_TEXTS)} {cases} END"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, column-pruned at the scan."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")


def cve_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised record frame (the 8 record fields plus ``ord``).

    ``cwe_ids`` is a zero- or one-element array; ``last_modified`` is empty.
    """
    docs = read_documents(spark, sf_dir)
    raw = docs.selectExpr(*[f"{expr} AS {name}" for name, expr in CVE_COLUMNS])
    return raw.select(
        "ord",
        "cve_id",
        "description",
        "published",
        F.lit("").alias("last_modified"),
        "cvss_score",
        "severity",
        F.when(F.col("cwe_id").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(F.col("cwe_id")))
        .alias("cwe_ids"),
        "source",
    )


def date_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "substr(CAST(o_orderdate AS STRING), 1, 10) AS d")
    return orders.selectExpr("o_orderkey AS ord", f"{date_texts_sql(0)} AS published")


def landed_records(records: DataFrame) -> DataFrame:
    """The records as a feed delivers them: every seventh one landed twice, and some
    without a position."""
    again = records.filter(F.col("ord") % 7 == 2)
    unplaced = (F.col("ord") % 20 == 4) | (F.col("ord") % 10 == 7)
    return records.unionByName(again).withColumn("ord", F.when(~unplaced, F.col("ord")))


# ---------------------------------------------------------------------------
# Source-shaped views of the relation, for the normalisation and ingest checks.
# ---------------------------------------------------------------------------
PAGE_SIZE = 100


def _fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return docs.selectExpr(*[f"{expr} AS {name}" for name, expr in CVE_COLUMNS])


def _cvss_entry(score, severity):
    return F.struct(F.struct(score.alias("baseScore"), severity.alias("baseSeverity")).alias("cvssData"))


def primary_entries(raw: DataFrame) -> DataFrame:
    """Each record as a nested API entry ``cve`` (plus its ``ord``).

    Variants by ``ord % 4``: 0 → V3.1 list (V3.0 ignored); 1 → empty V3.1, two
    V3.0 entries (first wins); 2 → V3.1 missing, one V3.0 entry; 3 → V3.1
    whose first entry has no data (no fall-through to V3.0). Records without
    a score have empty lists. The English description comes after a Spanish
    one, tagged ``en``/``EN-us``/``En``; every 17th record has only a French
    one. Weaknesses mix a catch-all code and the CWE id (doubled every 5th).
    """
    o = F.col("ord")
    score, sev = F.col("cvss_score"), F.col("severity")
    has = score.isNotNull()
    entry_t = "array<struct<cvssData:struct<baseScore:double,baseSeverity:string>>>"
    empty = F.array().cast(entry_t)
    main = F.array(_cvss_entry(score, sev)).cast(entry_t)
    decoy = F.array(_cvss_entry(F.lit(9.9), F.lit("CRITICAL"))).cast(entry_t)
    v31 = (
        F.when(~has, empty)
        .when(o % 4 == 0, main)
        .when(o % 4 == 1, empty)
        .when(o % 4 == 2, F.lit(None).cast(entry_t))
        .otherwise(F.array(F.struct(F.lit(None).cast("struct<baseScore:double,baseSeverity:string>").alias("cvssData"))).cast(entry_t))
    )
    v30 = (
        F.when(~has, empty)
        .when(o % 4 == 0, decoy)
        .when(o % 4 == 1, F.concat(main, decoy))
        .otherwise(main)
    )
    tag = F.when(o % 17 == 5, F.lit("fr")).when(o % 3 == 0, F.lit("en")).when(o % 3 == 1, F.lit("EN-us")).otherwise(F.lit("En"))
    spanish = F.struct(F.lit("es").alias("lang"), F.lit("Descripción no disponible.").alias("value"))
    own = F.struct(tag.alias("lang"), F.col("description").alias("value"))
    descriptions = F.when(F.col("description").isNull(), F.array(spanish)).otherwise(F.array(spanish, own))
    cwe = F.col("cwe_id")
    value_t = "array<struct<value:string>>"
    ids = F.when(o % 5 == 0, F.array(F.struct(cwe.alias("value")), F.struct(cwe.alias("value")))).otherwise(
        F.array(F.struct(cwe.alias("value")))
    )
    weaknesses = F.when(
        cwe.isNull(), F.array(F.struct(F.array(F.struct(F.lit("NVD-CWE-noinfo").alias("value"))).cast(value_t).alias("description")))
    ).otherwise(
        F.array(
            F.struct(F.array(F.struct(F.lit("NVD-CWE-Other").alias("value"))).cast(value_t).alias("description")),
            F.struct(ids.cast(value_t).alias("description")),
        )
    )
    cve = F.struct(
        F.col("cve_id").alias("id"),
        F.col("published").alias("published"),
        F.concat(F.lit("2025-02-"), F.lpad((o % 28 + 1).cast("string"), 2, "0")).alias("lastModified"),
        F.struct(v31.alias("cvssMetricV31"), v30.alias("cvssMetricV30")).alias("metrics"),
        descriptions.alias("descriptions"),
        weaknesses.alias("weaknesses"),
    )
    return raw.select("ord", cve.alias("cve"))


def pages_of(entries: DataFrame, in_order: bool = False) -> DataFrame:
    """Group entries into API pages by ``ord``, at most ``PAGE_SIZE`` on each.

    A page starts at a multiple of the page size, so its start needs nothing of
    the other pages; every fifth page is landed twice, as by a fetch that was
    repeated. ``in_order`` sorts the pages by their start over all partitions: the
    entries are dealt by ranges of pages, so the shuffle that gathers them also sorts.
    """
    page = F.floor(F.col("ord") / F.lit(PAGE_SIZE)).cast("long")
    keyed = entries.withColumn("page", page)
    grouped = (keyed.repartitionByRange("page") if in_order else keyed).groupBy("page").agg(
        F.sort_array(F.collect_list(F.struct(F.col("ord"), F.col("cve")))).alias("_items")
    )
    pages = grouped.select(
        (F.col("page") * PAGE_SIZE).alias("startIndex"),
        F.size("_items").cast("long").alias("resultsPerPage"),
        F.transform("_items", lambda x: F.struct(x.getField("cve").alias("cve"))).alias("vulnerabilities"),
        F.explode(F.when(F.col("page") % 5 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    pages = pages.drop("_copy")
    return pages.sortWithinPartitions("startIndex") if in_order else pages


def primary_pages(spark: SparkSession, sf_dir: str, only_source: str | None = None, in_order: bool = False) -> DataFrame:
    raw = _fixture_raw(spark, sf_dir)
    if only_source is not None:
        raw = raw.filter(F.col("source") == F.lit(only_source))
    return pages_of(primary_entries(raw), in_order)


def mirror_rows_of(raw: DataFrame, scores: tuple | None = None) -> DataFrame:
    """Each record as a flat mirror row (all text, unless ``scores`` gives other V4, V3, V2 columns).

    Score text placement by ``ord % 5``: 0 → V3 (V4, V2 decoys); 1 → V4 after
    an empty V3; 2 → V2 after empty V3/V4; 3 → V2 padded with spaces after
    missing V3/V4; 4 → unparseable V3 (the score becomes null). Severity is
    lower-cased on odd rows; catch-all or empty weakness codes replace
    missing ones; every 13th id is lower-cased.
    """
    o = F.col("ord")
    txt = F.col("cvss_score").cast("string")
    none = F.lit(None).cast("string")
    v3 = F.when(o % 5 == 0, txt).when(o % 5 == 4, F.lit("n/a")).when(o % 5 == 3, none).otherwise(F.lit(""))
    v4 = F.when(o % 5 == 0, F.lit("9.9")).when(o % 5 == 1, txt).when(o % 5 == 2, F.lit("")).when(o % 5 == 3, none).otherwise(F.lit("7.0"))
    v2 = F.when(o % 5 == 2, txt).when(o % 5 == 3, F.concat(F.lit(" "), txt, F.lit(" "))).otherwise(F.lit("1.0"))
    if scores is not None:
        v4, v3, v2 = scores
    sev = F.when(o % 2 == 1, F.lower(F.col("severity"))).otherwise(F.col("severity"))
    cwe = (
        F.when(F.col("cwe_id").isNotNull() & (o % 7 == 3), F.lit("Improper Input Validation"))
        .when(F.col("cwe_id").isNotNull(), F.col("cwe_id"))
        .when(o % 4 == 0, F.lit("NVD-CWE-Other"))
        .when(o % 4 == 1, F.lit("NVD-CWE-noinfo"))
        .when(o % 4 == 2, F.lit(""))
    )
    cid = F.when(o % 13 == 7, F.lower(F.col("cve_id"))).otherwise(F.col("cve_id"))
    return raw.select(
        o.alias("ord"),
        cid.alias("CVE-ID"),
        F.col("description").alias("DESCRIPTION"),
        v4.alias("CVSS-V4"),
        v3.alias("CVSS-V3"),
        v2.alias("CVSS-V2"),
        sev.alias("SEVERITY"),
        cwe.alias("CWE-ID"),
    )


def mirror_rows(spark: SparkSession, sf_dir: str, exclude_source: str | None = None) -> DataFrame:
    raw = _fixture_raw(spark, sf_dir)
    if exclude_source is not None:
        raw = raw.filter(F.col("source") != F.lit(exclude_source))
    return mirror_rows_of(raw)


def numeric_mirror_rows_of(raw: DataFrame) -> DataFrame:
    """Each record as a mirror row with number columns, in which 0 means absent.

    By ``ord % 4``: 0 → V3 (V4 a decoy); 1 → V4 after a zero V3; 2 → V2 after a
    missing V3 and a zero V4; 3 → no score at all.
    """
    o, score, none = F.col("ord"), F.col("cvss_score"), F.lit(None).cast("double")
    v3 = F.when(o % 4 == 0, score).when(o % 4 == 1, F.lit(0.0)).otherwise(none)
    v4 = F.when(o % 4 == 0, F.lit(9.9)).when(o % 4 == 1, score).when(o % 4 == 2, F.lit(0.0)).otherwise(none)
    v2 = F.when(o % 4 == 1, F.lit(5.0)).when(o % 4 == 2, score).otherwise(none)
    return mirror_rows_of(raw, (v4, v3, v2))


def numeric_mirror_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_mirror_rows_of(_fixture_raw(spark, sf_dir))
