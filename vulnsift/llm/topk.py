"""Exact top-k search by the threshold algorithm over sorted lists (operator 1)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.vectors import best_k, finite_vectors, frame, search_in_blocks

LONG = (1 << 63) - 1


def threshold_search(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = 10, scored: list[int] | None = None):
    """The ``k`` largest inner products of whole-number vectors for every query.

    Each dimension has a list of the rows sorted by that component. Sorted access
    goes down all lists together, from the end that the query's sign favours, in
    steps of a fourth of what is read. Rows met for the first time get their full score by random
    access. No row further down can score more than the bound: the sum over the
    dimensions of the query's component times the last value read. Reading stops
    when the bound is below the k-th score (at equality a smaller id may follow).
    ``scored`` collects the number of rows scored for each query.
    """
    n = len(data)
    reach = np.abs(data).max(initial=0) * np.abs(queries).max(initial=0) * data.shape[1]
    if reach >= 2.0**53:  # beyond exact doubles: Python integers, held within a long
        data, queries = data.astype(object), queries.astype(object)
        data, queries = (np.vectorize(int, otypes=[object])(x) for x in (data, queries))
    lists = np.argsort(data, axis=0, kind="stable").T.copy()
    values = np.take_along_axis(data, lists.T, axis=0).T
    out = []
    for at, query in enumerate(queries):
        dims = np.flatnonzero(query != 0)
        up = query[dims] > 0
        weights = query[dims]
        seen = ids == query_ids[at]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, data.dtype)
        read = met = 0
        while read < n:
            end = min(n, read + max(1, read // 4))
            top, low = lists[dims[up], n - end : n - read], lists[dims[~up], read:end]
            fresh = np.zeros(n, bool)
            fresh[top.ravel()] = True
            fresh[low.ravel()] = True
            if not len(dims):  # a zero query: every score is 0
                fresh[:] = True
            fresh &= ~seen
            new = np.flatnonzero(fresh)
            seen |= fresh
            met += len(new)
            if len(new):
                best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, data[new] @ query])
                kept = best_k(best_ids, best, k) if best.dtype != object else np.lexsort((best_ids, np.array([-x for x in best])))[:k]
                best_ids, best = best_ids[kept], best[kept]
            read = end
            if len(best) == k and read < n:
                last = np.empty(len(dims), data.dtype)
                last[up], last[~up] = values[dims[up], n - end], values[dims[~up], end - 1]
                if weights @ last < best[-1]:
                    break
        if scored is not None:
            scored.append(met)
        if best.dtype == object:
            best = np.array([max(-LONG - 1, min(LONG, x)) for x in best], np.int64)
        out.append((at, best_ids, best.astype(np.int64)))
    return frame(out)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 8192, query_rows: int = 4096) -> DataFrame:
    """For every query row its ``k`` highest scores over all other rows.

    Components become floor(scale * x); the score is the integer inner product.
    ``is_query`` is a condition on ``id``. Result: query_id, rank, vec_id, score;
    ties go to the smaller id; fewer than ``k`` candidates give all of them. A
    row is no candidate of a query with its own id, repeated rows with that id
    included; other repeated rows are candidates each. Rows with a null id, a null
    or empty vector, or a component that is null or not finite take no part.
    Vectors of different length are never compared. An empty table gives no rows;
    other columns are ignored. A score beyond a long is held at its limits.
    """
    rows = finite_vectors(vectors, id_col, vector_col)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))

    def search(ids, data, query_ids, queries):
        return threshold_search(ids, data, query_ids, queries, k)

    return search_in_blocks(rows, is_query, search, k, "long", block_rows, query_rows)
