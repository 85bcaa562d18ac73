"""Record order taken from the files, row by row.

A record that carries a position keeps it; one that carries none comes after those
that do, in the order of the files. The file order needs no sort: a file's rows lie in
splits, Spark knows where each split starts, and the splits are counted and their
counts summed up (two phases, as in ``operators.numbering``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.session import stored

POSITION = ("_path", "_block", "_row")


def with_position(scan: DataFrame, parquet: bool = False) -> DataFrame:
    """A file scan with the place of each row: file, start of the split, row.

    Call it on the scan itself. Parquet knows the row's number in its file; in
    text files the running id increases along a split.
    """
    row = F.col("_metadata.row_index") if parquet else F.monotonically_increasing_id()
    block = F.lit(0).cast("long") if parquet else F.col("_metadata.file_block_start")
    return scan.select("*", F.col("_metadata.file_path").alias("_path"), block.alias("_block"), row.alias("_row"))


def file_place() -> Column:
    """The place of a row as one value that sorts in the order of the files."""
    return F.struct(F.col("_path").alias("path"), F.col("_block").alias("block"), F.col("_row").alias("row"))


def frame_place() -> Column:
    """The place of a row in a frame that isn't read from files."""
    return F.struct(F.lit("").alias("path"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("row"))


def without_position(placed: DataFrame) -> DataFrame:
    return placed.drop(*POSITION)


def _split_counts(placed: DataFrame, given: Column) -> DataFrame:
    """A row for each split: its rows without a position, its first row, the rows of earlier
    splits, and the first position after those given. Only the position is read."""
    counts = placed.groupBy("_path", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(given.isNull()).alias("_missing"), F.min("_row").alias("_first"), F.max(given).alias("_last"),
    )
    # Unpartitioned windows over a row for each split, never over records.
    whole = Window.partitionBy(F.lit(1))
    before = whole.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.max("_last").over(whole) + 1, F.lit(0))
    return counts.withColumns({"_begin": begin, "_offset": F.coalesce(F.sum("_rows").over(before), F.lit(0))})


def with_file_order(placed: DataFrame, column: str = "ord") -> DataFrame:
    """``placed`` rows with ``column`` (added if there is none) filled where it is null.

    The rows without one get positions beyond the greatest one given, unique and in the
    order of files and rows (0, 1, ... if no row has one). Whether there are any is counted over all rows, reading the
    position only; if there are none the scan is returned as it is.
    """
    has = column in placed.columns
    given = F.col(column).cast("long") if has else F.lit(None).cast("long")
    # Splits of rows that all have a position need no number.
    splits = stored(_split_counts(placed, given).where("_missing > 0"), "splits")
    rows = without_position(placed)
    if splits.isEmpty():
        return rows.withColumn(column, given)
    s = splits.select(F.col("_path").alias("_p"), F.col("_block").alias("_b"), "_first", "_begin", "_offset")
    joined = placed.join(s, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")), "left")
    number = F.col("_begin") + F.col("_offset") + F.col("_row") - F.col("_first")
    filled = joined.withColumn(column, F.coalesce(given, number))
    return filled.select(*([] if has else [column]), *rows.columns)
