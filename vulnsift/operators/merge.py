"""Source precedence, ordered union and keep-first dedup.

Order is explicit and never a reason to lose a record: ``src_rank`` (primary
before mirror), then ``ord`` (position within the source; a record without one
comes last), then ``seq`` (its place in the files or frame, if the frame has it),
then a hash of the record. Repeated or missing values of ``ord`` are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.operators.numbering import numbered
from vulnsift.session import stored


def _has_id() -> Column:
    return F.coalesce(F.col("cve_id"), F.lit("")) != F.lit("")


def drop_known_ids(mirror: DataFrame, primary: DataFrame) -> DataFrame:
    """Mirror records whose id is non-empty and absent from the primary feed.

    Left anti join on the distinct primary ids; the planner broadcasts the id
    set when it is small at run time (AQE) and otherwise shuffles both sides,
    splitting skewed mirror keys.
    """
    ids = primary.select("cve_id").filter(_has_id()).distinct()
    return mirror.filter(_has_id()).join(ids, on="cve_id", how="left_anti")


def ordered_union(primary: DataFrame, mirror: DataFrame) -> DataFrame:
    """Primary records, then mirror records, told apart by ``src_rank``."""
    cols = primary.columns
    first = primary.withColumn("src_rank", F.lit(0))
    return first.unionByName(mirror.select(*cols).withColumn("src_rank", F.lit(1)))


def record_order(df: DataFrame) -> list[Column]:
    """The sort keys of a record frame, as far as it has them."""
    keys = [F.col(c).asc_nulls_last() for c in ("src_rank", "ord", "seq") if c in df.columns]
    return [*keys, F.xxhash64(*[c for c in df.columns if c not in ("src_rank", "ord", "seq")])]


def keep_first(df: DataFrame, key: str = "cve_id") -> DataFrame:
    """First record per non-empty key in record order.

    ``row_number() = 1`` is planned with a group limit before the shuffle: a
    task sends one record for a key however many it holds, so a hot key costs
    one record for each task.
    """
    has_key = F.coalesce(F.col(key), F.lit("")) != F.lit("")
    first = F.row_number().over(Window.partitionBy(key).orderBy(*record_order(df)))
    return df.filter(has_key).withColumn("_n", first).filter(F.col("_n") == 1).drop("_n")


def _order_keys(df: DataFrame) -> list[str]:
    return [c for c in ("src_rank", "ord", "seq") if c in df.columns]


def renumbered(df: DataFrame) -> DataFrame:
    """The records with a new ``ord``: 0, 1, ... in record order.

    Only what the order needs is sorted and numbered; the numbers then join the
    records, which stay as they are. ``df`` is read twice, so it should be a stored
    one; rows are told apart by a running id, so it must not change between.
    """
    kept = stored(df.withColumn("_id", F.monotonically_increasing_id()), "records")
    return _with_dense_order(kept, kept)


def _with_dense_order(records: DataFrame, chosen: DataFrame) -> DataFrame:
    """The ``records`` whose ``_id`` is among ``chosen``, numbered in record order."""
    keys = _order_keys(chosen)
    order = [*[F.col(c).asc_nulls_last() for c in keys], F.col("_hash"), F.col("_id")]
    narrow = chosen if "_hash" in chosen.columns else chosen.withColumn("_hash", record_order(chosen.drop("_id"))[-1])
    numbers = numbered(narrow.select(*keys, "_hash", "_id"), order, "_number").select(F.col("_id").alias("_of"), "_number")
    joined = records.join(numbers, F.col("_id") == F.col("_of"))
    return joined.withColumn("ord", F.col("_number")).drop("_id", "_of", "_number", "src_rank", "seq")


def keep_first_renumbered(stored_records: DataFrame, key: str = "cve_id") -> DataFrame:
    """``keep_first`` and ``renumbered`` of stored records that carry a unique ``_id``.

    Dedup and numbering work on narrow rows (key, order, hash, ``_id``); the whole records
    are read once, for the join with the ids that stay, which is the one shuffle that
    moves them. Ids are unique, so no key of that join is hot.
    """
    hashed = record_order(stored_records.drop("_id"))[-1].alias("_hash")
    narrow = stored_records.select(key, *_order_keys(stored_records), "_id", hashed)
    first = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in _order_keys(narrow)], "_hash", "_id"))
    has_key = F.coalesce(F.col(key), F.lit("")) != F.lit("")
    winners = narrow.filter(has_key).withColumn("_n", first).filter(F.col("_n") == 1).drop("_n")
    return _with_dense_order(stored_records, winners)
