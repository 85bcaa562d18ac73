"""Minimax contiguous partition of ordered atomic groups into shards (operator 10)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.llm.common import stored

DIGITS = 3  # hex digits of the group key by which a cell is divided further


@dataclass
class Cells:
    """Consecutive ranges of the group order: key prefix, bytes, and whether one group."""

    prefix: list[str]
    size: np.ndarray
    atomic: np.ndarray

    def __post_init__(self):
        self.before = np.concatenate([[0], np.cumsum(self.size)])


def _greedy(cells: Cells, shards: int, capacity: int, divisible: bool) -> list[int]:
    """Byte positions at which shards end if each takes all it can. A cell of many
    groups is cut nowhere, or (``divisible``) anywhere."""
    ends, at, total = [], 0, int(cells.before[-1])
    for _ in range(shards):
        target = at + capacity
        if target >= total:
            at = total
        else:
            i = int(np.searchsorted(cells.before, target, "right")) - 1
            at = target if divisible and not cells.atomic[i] else max(at, int(cells.before[i]))
        ends.append(at)
    return ends


def _smallest(cells: Cells, shards: int, least: int, divisible: bool) -> int:
    """The smallest capacity under which the greedy check places everything."""
    total = int(cells.before[-1])
    low, high = max(least, -(-total // shards)), max(total, least)
    while low < high:
        mid = (low + high) // 2
        if _greedy(cells, shards, mid, divisible)[-1] >= total:
            high = mid
        else:
            low = mid + 1
    return low


def _even(cells: Cells, shards: int, capacity: int) -> list[int]:
    """Byte positions at range ends at which shards end, none above a feasible
    ``capacity`` and each as near as may be to an equal share of what is left."""
    total, before = int(cells.before[-1]), cells.before
    least = [total]  # the earliest end of each shard that leaves the later ones enough
    for _ in range(shards - 1):
        least.append(int(before[np.searchsorted(before, least[-1] - capacity, "left")]))
    least.reverse()
    ends, at = [], 0
    for k in range(shards):
        low = int(np.searchsorted(before, max(at, least[k]), "left"))
        high = int(np.searchsorted(before, at + capacity, "right"))
        options = before[low:high]
        at = int(options[np.abs(options - (at + (total - at) / (shards - k))).argmin()])
        ends.append(at)
    return ends


def _cells(groups: DataFrame, digits: int) -> dict[str, tuple[int, int, int]]:
    """Prefix -> (bytes, groups, bytes of the largest group); at most 16^DIGITS rows for a parent."""
    rows = groups.groupBy(F.substring("group", 1, digits).alias("p")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"), F.max("bytes").alias("m")).collect()
    return {r["p"]: (r["b"], r["n"], r["m"]) for r in rows}


def minimax_cuts(groups: DataFrame, shards: int) -> list[str]:
    """First key prefixes of shards 1, 2, ... for ``groups`` (group: hex key, bytes).

    The order is that of the keys. The driver sees sums of key ranges. With cuts at
    range ends only, a binary search gives a capacity that works; with ranges
    divisible at will, one that cannot be beaten. Ranges in which a cut can lie
    for capacities between the two are divided further, until both agree. That is
    the smallest feasible capacity over single groups, and the driver holds a
    number of ranges that doesn't depend on the number of groups.
    """
    cells = _cells(groups, DIGITS)
    largest = max((m for _, _, m in cells.values()), default=0)
    while True:
        prefix = sorted(cells)
        if not prefix:
            return []
        own = Cells(prefix, np.array([cells[p][0] for p in prefix], np.int64), np.array([cells[p][1] == 1 for p in prefix]))
        least, works = (_smallest(own, shards, largest, d) for d in (True, False))
        unsure: set[int] = set()
        if least < works:
            for lo, hi in zip(_greedy(own, shards, least, False), _greedy(own, shards, works, True)):
                first = int(np.searchsorted(own.before, lo, "right")) - 1
                last = int(np.searchsorted(own.before, hi, "left")) - 1
                unsure |= {i for i in range(max(first, 0), min(last, len(prefix) - 1) + 1) if not own.atomic[i]}
        if not unsure:
            ends = _even(own, shards, works)
            total = int(own.before[-1])
            return [prefix[int(np.searchsorted(own.before, e, "left"))] for e in ends if e < total]
        by_length: dict[int, list[str]] = {}
        for i in unsure:
            by_length.setdefault(len(prefix[i]), []).append(prefix[i])
        for length, parents in by_length.items():
            inside = groups.where(F.substring("group", 1, length).isin(parents))
            for p in parents:
                del cells[p]
            cells |= _cells(inside, length + DIGITS)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``docs`` (doc_id, text) dealt into shards of nearly equal bytes.

    Documents of equal text stay together. A group larger than an equal share of
    what is left has a shard of its own (largest first); the others, in the order
    of a hash of their text, are cut into contiguous runs so that the largest run
    is as small as possible and the others as even as that allows. Size is the UTF-8 bytes of the text plus 1; null text
    counts as empty and shares its group. ``slot`` numbers a shard's rows from 0
    without gaps. Repeated rows and null ids take a slot each; an empty table
    gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[str] = []
    while len(alone) < shards - 1:  # at most a shard's worth of groups can exceed an equal share
        share = total / (shards - len(alone))
        large = groups.where(F.col("bytes") > share).where(~F.col("group").isin(alone)).orderBy(F.desc("bytes"), "group").limit(shards - 1 - len(alone)).collect()
        if not large:
            break
        alone += [r["group"] for r in large]
        total -= sum(r["bytes"] for r in large)
    rest = groups.where(~F.col("group").isin(alone)) if alone else groups
    cuts = minimax_cuts(rest, shards - len(alone))
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("group") >= F.lit(cut)).cast("int")
    for k, group in enumerate(alone):
        shard = F.when(F.col("group") == F.lit(group), F.lit(k)).otherwise(shard)
    # Slots: a shard's rows are numbered in buckets, and the buckets one after another.
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("shard", shard.cast("int")).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(buckets)))
    bases = dealt.groupBy("shard", "bucket").count().withColumn("base", F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).drop("count")
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "group")
    numbered = dealt.withColumn("own", F.row_number().over(order))
    # One row for a shard and bucket: shards x shuffle partitions at most.
    placed = numbered.join(F.broadcast(bases), ["shard", "bucket"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("own") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
