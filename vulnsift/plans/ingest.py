"""Ingest stage: two landed feeds → one deduplicated record set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vulnsift import config as K
from vulnsift.operators.merge import keep_first, keep_first_renumbered, ordered_union
from vulnsift.operators.normalise import RECORD_COLUMNS, normalise_mirror_rows, normalise_primary_pages


def merge_sources(primary: DataFrame, mirror: DataFrame) -> DataFrame:
    """Normalised primary + mirror records → deduplicated records (lazy).

    Keep-first on the ordered union also drops every mirror record whose id the
    primary feed has, so one shuffle does both jobs.
    """
    columns = [c for c in RECORD_COLUMNS if c in primary.columns and c in mirror.columns]
    return keep_first(ordered_union(primary.select(*columns), mirror.select(*columns)))


def ingest_frames(pages: DataFrame, mirror_rows: DataFrame) -> DataFrame:
    """Landed pages and mirror rows → deduplicated records (lazy)."""
    return merge_sources(normalise_primary_pages(pages), normalise_mirror_rows(mirror_rows))


def _source_count_exprs() -> list:
    src = F.col("source")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(src == F.lit(K.SOURCE_PRIMARY)).alias("nvd"),
        F.count_if(src == F.lit(K.SOURCE_MIRROR)).alias("huggingface"),
    ]


def source_counts(records: DataFrame) -> DataFrame:
    """Total records and records per named source, as one row."""
    return records.agg(*_source_count_exprs())


@dataclass
class IngestRun:
    counts: dict[str, int]
    output_path: str


def ingest(
    spark: SparkSession,
    pages_path: str,
    mirror_path: str,
    output_path: str,
    mirror_format: str = "csv",
    one_page_per_file: bool = True,
    fmt: str = "parquet",
) -> IngestRun:
    """Read both landings, merge, write the raw record file, return the counts.

    The normalised records are written once to the shared checkpoint folder, so
    the nested landing is parsed once however often the merge reads them. Which of
    them stay, and their ``ord`` (0, 1, ... in merged order), is found on narrow
    rows; the whole records are shuffled once, to join those.
    """
    from vulnsift.schemas import RECORD_SCHEMA
    from vulnsift.session import stored
    from vulnsift.sources.landing import read_mirror, read_primary_pages
    from vulnsift.sources.stagefiles import write_stage

    primary = normalise_primary_pages(read_primary_pages(spark, pages_path, one_page_per_file))
    mirror = normalise_mirror_rows(read_mirror(spark, mirror_path, mirror_format))
    # Both files hold whole texts: Zstandard writes a third less of them than Snappy.
    normalised = stored(ordered_union(primary, mirror).withColumn("_id", F.monotonically_increasing_id()), "normalised", "zstd")
    # The per-source counts are observed on the written rows: no second pass.
    counts = Observation("ingest_counts")
    merged = keep_first_renumbered(normalised).select(*[F.col(f.name) for f in RECORD_SCHEMA.fields])
    options = {"compression": "zstd"} if fmt == "parquet" else None
    write_stage(merged.observe(counts, *_source_count_exprs()), output_path, fmt, options=options)
    return IngestRun(counts={k: int(v) for k, v in counts.get.items()}, output_path=output_path)
