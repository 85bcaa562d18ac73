"""Sharding against exhaustive minimax partitions."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import lru_cache

from conftest import SF_SMALL
from pyspark.sql import functions as F

from vulnsift.llm import sharding


def best_capacity(sizes: list[int], shards: int) -> int:
    before = [0]
    for s in sizes:
        before.append(before[-1] + s)

    @lru_cache(None)
    def go(i: int, k: int) -> int:
        if k == 1:
            return before[-1] - before[i]
        return min((max(before[j] - before[i], go(j, k - 1)) for j in range(i, len(sizes) + 1)), default=0)

    return go(0, shards)


def test_cuts_are_minimax(spark):
    rng = random.Random(8)
    for n, shards in ((0, 3), (1, 4), (5, 8), (40, 4), (60, 8)):
        groups = sorted(("%032x" % rng.getrandbits(128), rng.choice([1, 5, 30, 200])) for _ in range(n))
        df = spark.createDataFrame(groups, "group string, bytes long")
        cuts = sharding.minimax_cuts(df, shards)
        assert len(cuts) < shards
        runs = defaultdict(int)
        for g, b in groups:
            runs[sum(g >= c for c in cuts)] += b
        assert max(runs.values(), default=0) == best_capacity([b for _, b in groups], shards)


def check(rows, docs, shards=8):
    assert len(rows) == len(docs)
    by_text, by_id = defaultdict(set), defaultdict(list)
    for d, t in docs:
        by_id[d].append(t)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        match = [t for t in by_id[r["doc_id"]] if len((t or "").encode()) + 1 == r["size"] and zlib.crc32((t or "").encode()) == r["text_crc32"]]
        assert match
        by_text[match[0] or ""].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_documents(odd_docs, no_docs):
    check(sharding.shard_documents(odd_docs).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert sharding.shard_documents(no_docs).count() == 0


def test_sizes_are_near_equal(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = sharding.shard_documents(docs)
    check(rows.collect(), [tuple(r) for r in docs.collect()])
    sizes = [r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.15 * sum(sizes) / 8


def test_a_large_group_has_a_shard_of_its_own(spark):
    rng = random.Random(1)
    docs = [(i, "same text " * 3) for i in range(300)] + [(i, "x" * rng.randint(1, 40)) for i in range(300, 900)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.shard_documents(df)
    check(rows.collect(), docs)
    sizes = {r[0]: r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()}
    assert sizes[0] == 300 * 31 and len(sizes) == 8
    rest = [v for k, v in sizes.items() if k]
    assert max(rest) <= 1.5 * min(rest)
