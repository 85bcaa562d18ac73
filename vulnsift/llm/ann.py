"""Approximate nearest neighbours by collision-counting hashing (operator 3)."""

from __future__ import annotations

import math
from itertools import count
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.vectors import best_k, finite_vectors, frame, search_in_blocks

HALF_WIDTH = 1.36  # of a window at radius 1: a point at distance 1 lies in it with probability 0.83
FIRST, FACTOR = 0.3, 1.02  # smallest window radius, and the finest step between radii
STRIDE = 4  # fine steps taken at once while few rows reach the threshold
BITE = 200  # a stride that would verify more than one row in so many is halved
BUCKETS, BUCKET = 128, 1 / 16  # of a projection, and the width of one; those at the ends take what lies beyond


def hashing_plan(miss: float = 0.1, passing: float = 0.1, contrast: float = 1.15) -> tuple[int, int]:
    """(projections, collisions needed) for a wished error.

    A row at distance d from the query lies in a window of radius r with probability
    p(d / r). The threshold lies so many deviations below the mean of a row at the
    radius that ``miss`` of such rows fall short, and there are as many projections as it
    takes for at most ``passing`` of the rows ``contrast`` times as far away to reach it.
    """
    normal = NormalDist()
    near, far = (2 * normal.cdf(HALF_WIDTH / d) - 1 for d in (1.0, contrast))
    below, above = normal.inv_cdf(1 - miss), normal.inv_cdf(1 - passing)
    for projections in count(1):
        needed = math.floor(projections * near - below * math.sqrt(projections * near * (1 - near)) + 0.5)
        if needed - 0.5 >= projections * far + above * math.sqrt(projections * far * (1 - far)):
            return projections, needed


def bucket_index(values: np.ndarray) -> np.ndarray:
    """For each border of buckets and each projection (a row of ``values``) the set of the
    rows that lie below it, a bit for each: two of them give the rows of any window, whatever
    its width."""
    projections, n = values.shape
    bucket = np.full((projections, -(-n // 64) * 64), BUCKETS, np.uint8)  # what fills the last word lies below no border
    bucket[:, :n] = np.clip(values / BUCKET + BUCKETS // 2, 0, BUCKETS - 1)
    below = np.empty((BUCKETS + 1, projections, bucket.shape[1] // 64), np.uint64)
    for border in range(BUCKETS + 1):
        below[border] = np.packbits(bucket < border, axis=1, bitorder="little").view(np.uint64)
    return below


def met_often(sets: np.ndarray, needed: int) -> np.ndarray:
    """The set of the rows that lie in at least ``needed`` of ``sets``. The counts are held
    by their binary digits, a set for each, and three sets are added at a time."""
    reached = np.full(sets.shape[1], ~np.uint64(0))
    while len(sets):
        carried = []
        while len(sets) > 1:
            third = max(1, len(sets) // 3)
            one, two, three = sets[:third], sets[third : 2 * third], sets[2 * third : 3 * third]
            either = one ^ two
            if len(three):
                carried.append((one & two) | (either & three))
                sets = np.concatenate([either ^ three, sets[3 * third :]])
            else:
                carried.append(one & two)
                sets = either
        reached = sets[0] & reached if needed & 1 else sets[0] | reached
        needed >>= 1
        sets = np.concatenate(carried) if carried else sets[:0]
    return reached if not needed else np.zeros_like(reached)


def collision_search(
    ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = 5, miss: float = 0.1, passing: float = 0.1, contrast: float = 1.15, seed: int = 7, verified: list[int] | None = None
):
    """Nearest rows by cosine. The index holds the buckets of random projections
    of the unit vectors (``bucket_index``). A query opens a window around its own value in
    each, up to the nearest borders; a larger radius widens all windows, which is
    hashing with wider buckets. A row in at least the planned number of windows
    (``hashing_plan``) is verified by its exact cosine. The search ends when the k-th
    verified distance is within the radius, at the latest when the windows hold every row.
    ``verified`` collects the number of rows verified for each query."""
    n, dim = data.shape
    projections, needed = hashing_plan(miss, passing, contrast)
    norms, query_norms = np.sqrt((data * data).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    axes = np.random.default_rng(seed).standard_normal((dim, projections))
    below, each = bucket_index(np.nan_to_num((data / norms[:, None]) @ axes).T), np.arange(projections)
    last = math.ceil(math.log(2 / FIRST, FACTOR))

    def colliding(centres: np.ndarray, radius: float) -> np.ndarray:
        """Whether each row is in enough windows of the radius."""
        low = np.clip(np.rint((centres - HALF_WIDTH * radius) / BUCKET) + BUCKETS // 2, 0, BUCKETS - 1).astype(int)
        high = np.clip(np.rint((centres + HALF_WIDTH * radius) / BUCKET) + BUCKETS // 2, 1, BUCKETS).astype(int)
        rows = met_often(below[low, each] ^ below[high, each], needed)
        return np.unpackbits(rows.view(np.uint8), count=n, bitorder="little").view(bool)

    out, ended = [], 0
    for at in np.argsort(query_ids, kind="stable").tolist():
        query = queries[at]
        centres = np.nan_to_num((query / query_norms[at]) @ axes)
        open_ = ids != query_ids[at]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        # The first windows are a little narrower than those that answered the query before.
        step, stride, start, tested = -1, STRIDE, max(0, ended - STRIDE), 0
        met: dict[int, np.ndarray] = {}
        while step < last:
            ahead = start if step < 0 else min(last, step + stride)
            if step >= 0 and len(best) == k:  # a wider window than that of the k-th distance isn't needed
                ahead = min(ahead, max(step + 1, math.ceil(math.log(max(1.0, (2 - 2 * best[-1]) / FIRST**2), FACTOR) / 2)))
            radius = FIRST * FACTOR**ahead
            if ahead not in met:
                met[ahead] = colliding(centres, radius)
            new = np.flatnonzero(open_ & met[ahead])
            if len(new) > 2 * k + n // BITE:
                if step < 0 and start:
                    start //= 2
                    continue
                if step >= 0 and stride > 1:
                    stride //= 2
                    continue
            step = ahead
            if step == last:
                new = np.flatnonzero(open_)
            open_[new] = False
            if len(new):
                tested += len(new)
                # Summed along each row, so that equal rows have equal cosines.
                cosines = (data[new] * query).sum(axis=1) / (norms[new] * query_norms[at])
                best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, cosines])
                kept = best_k(best_ids, best, k)
                best_ids, best = best_ids[kept], best[kept]
            if len(best) == k and 2 - 2 * best[-1] <= radius * radius:
                break
        ended = step
        if verified is not None:
            verified.append(tested)
        out.append((at, best_ids, best))
    return frame(out)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 8192, query_rows: int = 4096) -> DataFrame:
    """For every query row its ``k`` nearest other rows found, by cosine.

    ``is_query`` is a condition on ``id``. Result: query_id, rank, vec_id, score
    (the exact cosine); ties go to the smaller id; with ``k`` candidates or fewer
    all are found. Every row is indexed. A row is no candidate of a query with its
    own id; other repeated rows are candidates each. Rows with a null id, a null,
    empty or zero vector, or a component that is null or not finite take no part.
    Vectors of different length are never compared. An empty table gives no rows;
    other columns are ignored.
    """
    rows = finite_vectors(vectors, id_col, vector_col).where(F.exists("vec", lambda x: x != 0))

    def search(ids, data, query_ids, queries):
        return collision_search(ids, data, query_ids, queries, k)

    return search_in_blocks(rows, is_query, search, k, "double", block_rows, query_rows)
