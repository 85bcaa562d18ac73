"""Exact and approximate vector search against brute force."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from vulnsift.llm import ann, topk

SF_LARGE = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, block int"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [math.nan] * 6), (204, [math.inf] + [0.0] * 5), (205, [0.0] * 6), (None, [1.0] * 6)]
    rows += [(210, [1.0, 2.0]), (220, [2.0, 1.0]), rows[3], rows[3], rows[20]]
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)


def usable(rows, zero=True):
    out = []
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out.append((r["vec_id"], np.array(v, float)))
    return out


def brute(rows, every, k, score):
    want = {}
    for n, (q, v) in enumerate(rows):
        if q % every == 0:
            found = sorted(((-score(v, w), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
            want.setdefault(q, []).append([(i, -s) for s, i in found])
    return want


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in got.items()}


def test_top_k(odd_vectors):
    got = answers(topk.top_k(odd_vectors, F.col("id") % 10 == 0, block_rows=40, query_rows=5))
    want = brute(usable(odd_vectors.collect()), 10, 10, lambda a, b: int(np.floor(1024 * a) @ np.floor(1024 * b)))
    single = {q: a[0] for q, a in want.items() if len(a) == 1 and a[0]}
    assert {q: got[q] for q in single} == single
    assert set(got) == {q for q, a in want.items() if a[0]}


def test_top_k_of_huge_components_is_exact():
    data = np.array([[2.0**40, 3.0], [2.0**40, 5.0], [-(2.0**40), 1.0]])
    at, ids, scores = topk.threshold_search(np.arange(3), data, np.array([9]), np.array([[2.0**14, 1.0]]), 3)
    assert ids.tolist() == [1, 0, 2] and scores.tolist() == [2**54 + 5, 2**54 + 3, -(2**54) + 1]


def test_nearest_finds_all_of_few(odd_vectors):
    got = answers(ann.nearest(odd_vectors, F.col("id") % 10 == 0))
    rows = usable(odd_vectors.collect(), zero=False)
    cos = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    want = brute(rows, 10, 5, cos)
    hits = total = 0
    for q, lists in want.items():
        if len(lists) == 1 and lists[0]:
            assert len(got[q]) == len(lists[0])
            scores = [s for _, s in got[q]]
            assert scores == sorted(scores, reverse=True)
            own = dict(rows)
            for i, s in got[q]:
                assert s == pytest.approx(cos(own[q], own[i]), abs=1e-12)
            total += len(lists[0])
            hits += sum(s >= lists[0][-1][1] - 1e-12 for s in scores)
    assert hits >= 0.9 * total


def recall_and_share(ids, data, queries):
    """Recall of the five nearest, and the share of all rows that was verified."""
    verified = []
    at, found, _ = ann.collision_search(ids, data, ids[queries], data[queries], verified=verified)
    unit = data / np.linalg.norm(data, axis=1)[:, None]
    hits = 0
    for k, q in enumerate(queries):
        s = unit @ unit[q]
        s[q] = -2
        hits += len(set(ids[np.argsort(-s)[:5]]) & set(found[at == k]))
    figures = hits / 5 / len(queries), sum(verified) / len(queries) / len(ids)
    print(f"{len(ids)} rows: recall {figures[0]:.3f}, verified {figures[1]:.3f}")
    return figures


def test_recall_on_the_given_vectors(spark):
    rows = usable(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect(), zero=False)
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert recall_and_share(ids, data, np.flatnonzero(ids % 5 == 0))[0] >= 0.9


def test_few_rows_are_verified(spark):
    rows = usable(spark.read.parquet(f"{SF_LARGE}/embeddings.parquet").collect(), zero=False)
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    recall, share = recall_and_share(ids, data, np.flatnonzero(ids % 20 == 0))
    assert recall >= 0.9 and share < 0.1
    data = np.random.default_rng(5).standard_normal((16384, 64))
    recall, share = recall_and_share(np.arange(16384), data, np.arange(0, 16384, 512))
    assert recall >= 0.9 and share < 0.05


def test_hashing_plan_keeps_its_errors():
    normal = NormalDist()
    for miss, passing, contrast in ((0.1, 0.1, 1.15), (0.02, 0.05, 1.3)):
        m, needed = ann.hashing_plan(miss, passing, contrast)
        for distance, least, most in ((1.0, 1 - miss - 0.01, 1.0), (contrast, 0.0, passing + 0.01)):
            p = 2 * normal.cdf(ann.HALF_WIDTH / distance) - 1
            reached = sum(math.comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(needed, m + 1))
            assert least <= reached <= most


def test_bound_stops_early_on_skewed_vectors():
    rng = np.random.default_rng(6)
    skewed = {
        "norms": 100 * rng.standard_normal((4096, 64)) * rng.lognormal(0, 1, (4096, 1)),
        "dimensions": 100 * rng.standard_normal((4096, 64)) * 0.7 ** np.arange(64),
    }
    for name, data in skewed.items():
        data, ids, scored = np.floor(data), np.arange(4096), []
        at, found, scores = topk.threshold_search(ids, data, ids[:40], data[:40], scored=scored)
        share = sum(scored) / 40 / 4096
        print(f"skewed {name}: scored {share:.3f}")
        assert share < 0.6
        for q in range(40):
            s = data @ data[q]
            want = [i for i in np.lexsort((ids, -s)) if i != q][:10]
            assert sorted(found[at == q], key=lambda i: (-s[i], i)) == want and set(scores[at == q]) == set(s[want])


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(none, F.col("id") % 10 == 0).count() == 0
    assert ann.nearest(none, F.col("id") % 10 == 0).count() == 0


def test_collisions_are_counted_by_sets():
    rng = np.random.default_rng(8)
    for n, projections in ((1, 1), (63, 2), (64, 5), (200, 273)):
        values = rng.standard_normal((projections, n)) * 3
        below = ann.bucket_index(values)
        bits = lambda sets: np.unpackbits(sets.view(np.uint8), axis=-1, bitorder="little")
        assert not below[0].any() and (bits(below[-1])[:, :n] == 1).all() and not bits(below[-1])[:, n:].any()
        low, high = ann.BUCKETS // 2 - 20, ann.BUCKETS // 2 + 9
        windows = below[low] ^ below[high]
        inside = (values >= -20 * ann.BUCKET) & (values < 9 * ann.BUCKET)
        assert (bits(windows)[:, :n] == inside).all()
        for needed in range(1, projections + 2):
            assert (bits(ann.met_often(windows, needed))[:n] == (inside.sum(axis=0) >= needed)).all()


def test_a_query_counts_few_windows_of_a_large_block(monkeypatch):
    counted, real = [], ann.met_often
    monkeypatch.setattr(ann, "met_often", lambda sets, needed: counted.append(sets.nbytes) or real(sets, needed))
    data = np.random.default_rng(9).standard_normal((8192, 64))
    recall, share = recall_and_share(np.arange(8192), data, np.arange(0, 8192, 128))
    # An 8th of a byte for each row and projection at a time.
    assert recall >= 0.9 and share < 0.05 and max(counted) == 8192 * ann.hashing_plan()[0] / 8 and len(counted) < 14 * 64
