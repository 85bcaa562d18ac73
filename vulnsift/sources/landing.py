"""Scans of the landed feeds (the network fetch itself is outside Spark).

* Primary feed: one JSON document per landed API page (``startIndex``,
  ``vulnerabilities``), read with the nested schema so only the declared fields
  are parsed. JSON lines with a page on each line split over tasks; one page per
  file (as fetched) is a task for each file.
* Mirror feed: flat rows as Parquet (text or number columns) or CSV with a
  header in any column order. ``csv`` has a row on each line and splits over
  tasks; ``csv-multiline`` allows line breaks inside quotes, at a task per file.

Order is decided row by row: a row that carries its position (``startIndex``, ``ord``)
is taken there; rows without one come after those, in the order of the files and of
the rows in them. Pages bring their place in the files along (``place``), which also
says which of two landings of one position came first. No read sorts anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnsift.schemas import MIRROR_COLUMNS, NVD_PAGE_SCHEMA
from vulnsift.sources.ordering import POSITION, file_place, with_file_order, with_position, without_position

MIRROR_FORMATS = ("csv", "csv-multiline", "parquet")


def read_primary_pages(spark: SparkSession, path: str, one_page_per_file: bool = True) -> DataFrame:
    """Landed pages: one JSON document per file (as fetched), or JSON lines
    with one page per line when ``one_page_per_file`` is false. ``place`` is each
    page's place in the files."""
    reader = spark.read.schema(NVD_PAGE_SCHEMA).option("mode", "FAILFAST")
    placed = with_position(reader.option("multiLine", one_page_per_file).json(path))
    return without_position(placed.withColumn("place", file_place()))


def _mirror_scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    options = {"header": True, "escape": '"', "multiLine": fmt == "csv-multiline"}
    names = spark.read.options(**options).csv(path).columns
    types = [T.StructField(n, T.LongType() if n == "ord" else T.StringType()) for n in names]
    return spark.read.schema(T.StructType(types)).options(**options, enforceSchema=False, mode="FAILFAST").csv(path)


def read_mirror(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Mirror rows: ``ord`` and the declared columns, each of the type that the file gives
    it, and ``place``. Rows without ``ord`` get one that follows those given, in file order."""
    if fmt not in MIRROR_FORMATS:
        raise ValueError(f"unsupported mirror format: {fmt}")
    scan = _mirror_scan(spark, path, fmt)
    missing = [c for c in MIRROR_COLUMNS if c not in scan.columns]
    if missing:
        raise ValueError(f"the mirror at '{path}' lacks the columns {missing}")
    columns = [F.col(f"`{c}`") for c in MIRROR_COLUMNS]
    placed = with_position(scan, parquet=fmt == "parquet")
    own = [F.col("ord").cast("long").alias("ord")] if "ord" in scan.columns else []
    return with_file_order(placed.select(*own, *columns, file_place().alias("place"), *POSITION))
