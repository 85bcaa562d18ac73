"""Stage files: the written output of one stage and input of the next.

Parquet is the default: the next stage reads only the columns it needs and
pushes simple predicates (e.g. ``composite_score >= 0.6``) into the scan.
JSON lines reproduce the original interchange format (one object per line,
nulls written) for consumers that expect it.

Records without ``ord`` get one that follows those given, in the order of the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vulnsift.sources.jsonl import EmptyInputError, scan_jsonl, write_jsonl
from vulnsift.sources.ordering import with_file_order, with_position

FORMATS = ("parquet", "json")


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "overwrite",
                partition_by: str | None = None, options: dict[str, str] | None = None) -> None:
    if fmt == "json":
        write_jsonl(df, path, mode=mode, partition_by=partition_by, options=options)
        return
    if fmt != "parquet":
        raise ValueError(f"unsupported stage format: {fmt}")
    writer = df.write.mode(mode).options(**options or {})
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", *,
               require_rows: bool = False) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported stage format: {fmt}")
    scan = scan_jsonl(spark, path, schema) if fmt == "json" else spark.read.schema(schema).parquet(path)
    if require_rows and scan.isEmpty():
        raise EmptyInputError(f"No records found in '{path}'.")
    if "ord" not in schema.names:
        return scan
    return with_file_order(with_position(scan, parquet=fmt == "parquet")).select(*schema.names)
