"""JSON-lines scan and sink for stage files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class EmptyInputError(ValueError):
    """Raised when a stage input exists but holds no records."""


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, *, require_rows: bool = False) -> DataFrame:
    """Read JSON lines with an explicit schema; a malformed line fails the job.

    Blank lines are skipped. A missing path raises Spark's ``PATH_NOT_FOUND``
    analysis error; ``require_rows`` additionally rejects an empty input.
    """
    df = scan_jsonl(spark, path, schema)
    if require_rows and df.isEmpty():
        raise EmptyInputError(f"No records found in '{path}'.")
    return df


def write_jsonl(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """One JSON object per line; null fields are written, not dropped."""
    writer = df.write.mode(mode).options(ignoreNullFields="false", **options or {})
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.json(path)
