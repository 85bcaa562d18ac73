"""Normalise the two feeds into the flat record shape.

Every record carries ``ord``, its position in the source's own numbering (null
if the source has none), and ``seq``, its place in the files (``place`` of the reads) or,
in a frame that comes from elsewhere, in the frame.

Primary feed: landed API pages, one row per page with a ``vulnerabilities``
array. ``posexplode`` yields one record per entry with
``ord = startIndex + position``; every landed page counts, in whatever state of
the feed it was fetched. CVSS, English description and weakness ids
are picked with higher-order array functions (no UDF, no explode of the
inner arrays).

Mirror feed: flat text rows. The CVSS text is coalesced by truthiness
(V3, then V4, then V2) and parsed as a plain number, number columns are
coalesced the same way with 0 as absent; severity is
upper-cased; one weakness id is wrapped unless it is a catch-all code; the
publication year is read from the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.functions.numbers import parse_plain_number
from vulnsift.sources.ordering import frame_place

RECORD_COLUMNS = (
    "ord",
    "cve_id",
    "description",
    "published",
    "last_modified",
    "cvss_score",
    "severity",
    "cwe_ids",
    "source",
    "seq",
)


def pick_cvss(metrics: Column) -> Column:
    """(baseScore, baseSeverity) of the first entry of V3.1, else of V3.0.

    The first non-empty list wins even when its first entry lacks data.
    """
    v31, v30 = metrics.getField("cvssMetricV31"), metrics.getField("cvssMetricV30")
    first31 = F.get(v31, 0).getField("cvssData")
    first30 = F.get(v30, 0).getField("cvssData")
    return (
        F.when(F.coalesce(F.size(v31), F.lit(0)) > 0, first31)
        .when(F.coalesce(F.size(v30), F.lit(0)) > 0, first30)
    )


def pick_english_description(descriptions: Column) -> Column:
    """Value of the first description tagged ``en``/``en-us`` (any case); else ''."""
    english = F.filter(
        descriptions,
        lambda d: F.lower(F.coalesce(d.getField("lang"), F.lit(""))).isin(*K.ENGLISH_TAGS),
    )
    return F.coalesce(F.get(english, 0).getField("value"), F.lit(""))


def pick_cwe_ids(weaknesses: Column) -> Column:
    """All weakness values starting ``CWE-`` in order, duplicates kept."""
    nested = F.transform(
        F.coalesce(weaknesses, F.array()),
        lambda w: F.transform(F.coalesce(w.getField("description"), F.array()), lambda x: x.getField("value")),
    )
    return F.filter(F.flatten(nested), lambda v: F.coalesce(v.startswith(K.CWE_PREFIX), F.lit(False)))


def _place(frame: DataFrame) -> Column:
    return F.col("place") if "place" in frame.columns else frame_place()


def normalise_primary_pages(pages: DataFrame) -> DataFrame:
    """Landed pages → one flat record per vulnerability entry, in page order."""
    entries = pages.select(
        F.col("startIndex").alias("_start"),
        _place(pages).alias("_place"),
        F.posexplode(F.coalesce(F.col("vulnerabilities"), F.array())).alias("_pos", "_item"),
    )
    cve = F.col("_item").getField("cve")
    with_cvss = entries.select(
        (F.col("_start") + F.col("_pos")).cast("long").alias("ord"),
        F.struct("_place", F.col("_pos").alias("entry")).alias("seq"),
        cve.alias("_cve"),
        pick_cvss(cve.getField("metrics")).alias("_cvss"),
    )
    c = F.col("_cve")
    return with_cvss.select(
        "ord",
        F.coalesce(c.getField("id"), F.lit("")).alias("cve_id"),
        pick_english_description(c.getField("descriptions")).alias("description"),
        F.coalesce(c.getField("published"), F.lit("")).alias("published"),
        F.coalesce(c.getField("lastModified"), F.lit("")).alias("last_modified"),
        F.col("_cvss").getField("baseScore").cast("double").alias("cvss_score"),
        F.col("_cvss").getField("baseSeverity").alias("severity"),
        pick_cwe_ids(c.getField("weaknesses")).alias("cwe_ids"),
        F.lit(K.SOURCE_PRIMARY).alias("source"),
        "seq",
    )


def _truthy_text(col: Column) -> Column:
    return F.when(col != F.lit(""), col)


def _truthy(df: DataFrame, name: str) -> Column:
    """The column where the feed's value counts as present: text that isn't empty,
    a number that isn't zero."""
    col = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() == "string":
        return _truthy_text(col)
    return F.when(col != F.lit(0), col)


def mirror_cvss(rows: DataFrame) -> Column:
    """V3 or V4 or V2, the first that counts as present (the last in any case), as a
    number. Columns of numbers and of text may be mixed."""
    number = lambda name, col: parse_plain_number(col) if rows.schema[name].dataType.typeName() == "string" else col.cast("double")
    v3, v4 = _truthy(rows, "CVSS-V3"), _truthy(rows, "CVSS-V4")
    return (
        F.when(v3.isNotNull(), number("CVSS-V3", v3))
        .when(v4.isNotNull(), number("CVSS-V4", v4))
        .otherwise(number("CVSS-V2", F.col("`CVSS-V2`")))
    )


def mirror_severity(sev: Column) -> Column:
    """Empty → null, else upper-cased."""
    return F.upper(_truthy_text(sev))


def mirror_cwe_ids(cwe: Column) -> Column:
    """One-element list unless empty or a catch-all placeholder code."""
    keep = F.coalesce((cwe != F.lit("")) & ~cwe.isin(*K.WEAKNESS_PLACEHOLDERS), F.lit(False))
    return F.when(keep, F.array(cwe)).otherwise(F.array().cast("array<string>"))


def year_from_id(cve_id: Column) -> Column:
    """Second dash-separated field of a ``CVE-`` id when it is all digits, else ''."""
    field = F.split_part(cve_id, F.lit("-"), F.lit(2))
    ok = cve_id.startswith("CVE-") & field.rlike("^[0-9]+$")
    return F.when(F.coalesce(ok, F.lit(False)), field).otherwise(F.lit(""))


def normalise_mirror_rows(rows: DataFrame) -> DataFrame:
    """Flat mirror rows → records; rows with an empty id are skipped.

    A null description becomes the text ``None`` (how the feed's text
    conversion renders a missing value).
    """
    cid = F.col("`CVE-ID`")
    kept = rows.filter(F.coalesce(cid, F.lit("")) != F.lit(""))
    return kept.select(
        (F.col("ord") if "ord" in rows.columns else F.lit(None)).cast("long").alias("ord"),
        cid.alias("cve_id"),
        F.coalesce(F.col("DESCRIPTION"), F.lit("None")).alias("description"),
        year_from_id(cid).alias("published"),
        F.lit("").alias("last_modified"),
        mirror_cvss(rows).alias("cvss_score"),
        mirror_severity(F.col("SEVERITY")).alias("severity"),
        mirror_cwe_ids(F.col("`CWE-ID`")).alias("cwe_ids"),
        F.lit(K.SOURCE_MIRROR).alias("source"),
        F.struct(_place(rows).alias("_place"), F.lit(0).alias("entry")).alias("seq"),
    )
