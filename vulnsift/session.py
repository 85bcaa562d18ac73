"""Session helpers: a local session for tests/benchmarks and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "vulnsift") -> SparkSession:
    """A local session configured like the cluster defaults we rely on.

    On a cluster the session comes from the platform; only tests and the
    benchmark build one here.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets this to a shared, fault-tolerant location and we use it as
    is. Only a local-mode session (tests) without the setting gets a fresh
    local scratch folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: point it at shared storage (e.g. the cluster's distributed file system)"
        )
    folder = tempfile.mkdtemp(prefix="vulnsift-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths`` (missing paths count 0)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        if not p:
            continue
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that it names (or the default one)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared checkpoint folder
    and read it back. ``compression``: a codec other than the session's own."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def published_folder(spark: SparkSession, target: str) -> Iterator[str]:
    """A staging folder beside ``target`` that takes its place if the block succeeds.

    If the block fails, the staging folder goes and ``target`` is as before. The
    exchange is two renames, the earlier folder first; if the second fails the first is undone, and
    if the driver dies between them the next run begins by undoing it. On a store
    without folder renames each is a copy.
    """
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    target = target.rstrip("/")
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staging, earlier = f"{target}.staging-{uuid.uuid4().hex}", f"{target}.earlier"
    if not fs.exists(path(target)) and fs.exists(path(earlier)):
        fs.rename(path(earlier), path(target))
    try:
        yield staging
    except BaseException:
        fs.delete(path(staging), True)
        raise
    fs.delete(path(earlier), True)
    had = fs.exists(path(target))
    if had and not fs.rename(path(target), path(earlier)):
        raise OSError(f"can't set '{target}' aside; the new output is in '{staging}'")
    if not fs.rename(path(staging), path(target)):
        if had:
            fs.rename(path(earlier), path(target))
        raise OSError(f"can't publish '{staging}' as '{target}'")
    fs.delete(path(earlier), True)


@contextmanager
def sized_shuffles(spark: SparkSession, nbytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> Iterator[int]:
    """For one run, let AQE start from one shuffle partition per ``target_bytes`` of input.

    AQE coalesces small partitions but cannot split an oversized one outside
    joins, so the initial number must fit the largest shuffle (the id dedup
    moves every record once). The session's own settings come back afterwards,
    so the next run is sized by its own input.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-nbytes // target_bytes))
    settings = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield wanted
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
