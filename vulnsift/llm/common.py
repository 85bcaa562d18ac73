"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vulnsift
from vulnsift.session import ensure_checkpoint_dir

BATCH_BYTES = 2 << 20
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application: their Python
    workers need not find it by a path of their own."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(vulnsift.__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="vulnsift-package-"), "vulnsift_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


_HELD: dict[str, tuple[object, object]] = {}


def held(kind: str, key: object, make: Callable[[], object]):
    """What a worker keeps between tasks: one object of one kind (workers are
    reused, so a job of several operators would otherwise pile up their tables)."""
    found = _HELD.get(kind)
    if found is None or found[0] is not key and found[0] != key:
        _HELD.clear()
        found = _HELD[kind] = (key, make())
    return found[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by whatever path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the checkpoint folder that all nodes share."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query run inside go when it ends, not when the driver
    next happens to collect its garbage. The session's own setting comes back afterwards."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it
    back. A lost executor then costs the tasks it ran, not what came before; what the
    write shuffled is deleted. ``compression``: a codec other than the session's own."""
    path = shared_path(df.sparkSession, tag)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slice batches so that one slice holds at most ``limit`` bytes of ``column``
    (a single longer value makes a slice of its own)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
