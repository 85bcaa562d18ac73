"""Report stage: every report table from one scored input, written as tables.

The scored input is read in a few passes with only the columns the report needs (column
pruning reaches the scan); only order statistics, a few numbers, reach the driver. Chart drawing and HTML are
presentation and not built here: the tables are the chart data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnsift.config import DEFAULT_CONFIG, CurationConfig
from vulnsift.operators.report import build_report
from vulnsift.schemas import REPORT_TABLES, SCORED_SCHEMA
from vulnsift.session import path_exists, stored
from vulnsift.sources.jsonl import EmptyInputError, write_jsonl
from vulnsift.sources.stagefiles import read_stage


@dataclass
class ReportRun:
    tables: dict[str, str]  # table name → output folder


def load_scored(spark: SparkSession, scored_path: str, fmt: str = "json") -> DataFrame:
    """Scored records; a missing path raises, an empty input raises ``EmptyInputError``."""
    if not path_exists(spark, scored_path):
        raise FileNotFoundError(f"Scored data not found at '{scored_path}'. Run the score stage first.")
    return read_stage(spark, scored_path, SCORED_SCHEMA, fmt, require_rows=True)


def generate_report(
    spark: SparkSession,
    scored_path: str,
    output_dir: str,
    cfg: CurationConfig = DEFAULT_CONFIG,
    fmt: str = "json",
) -> ReportRun:
    """Compute all report tables from the scored file and write each under ``output_dir``
    (each table is small: one JSON file per table).

    Passes over the scored records: global statistics, top 50, severity labels,
    and those of the order statistics. Their small results are stored below the shared
    ``spark.checkpoint.dir`` and every table is derived from those.
    """
    scored = load_scored(spark, scored_path, fmt)
    tables = {}
    report = build_report(scored, cfg, materialise=lambda df: stored(df, "report"))
    for name, table in report.items():
        path = f"{output_dir}/{name}"
        write_jsonl(table.coalesce(1), path)
        tables[name] = path
    return ReportRun(tables=tables)


def read_report(spark: SparkSession, run: ReportRun) -> DataFrame:
    """Every value of every table that a run wrote, a row for each: ``report_table, row`` (the
    key of its row), ``field``, and ``text`` or ``number``."""
    parts = []
    for name, (keys, texts, numbers) in REPORT_TABLES.items():
        types = {**dict.fromkeys((*keys, *texts), "string"), **dict.fromkeys(numbers, "double")}
        table = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in types.items())).json(run.tables[name])
        none, nan = F.lit(None).cast("string"), F.lit(None).cast("double")
        values = [F.struct(F.lit(c).alias("field"), F.col(c).alias("text"), nan.alias("number")) for c in texts]
        values += [F.struct(F.lit(c).alias("field"), none.alias("text"), F.col(c).alias("number")) for c in numbers]
        parts.append(table.select(F.lit(name).alias("report_table"), F.concat_ws("/", *keys).alias("row"), F.inline(F.array(*values))))
    return reduce(DataFrame.unionAll, parts)


__all__ = ["generate_report", "load_scored", "read_report", "ReportRun", "EmptyInputError"]
