"""Vectors and query sets dealt into blocks for the two searches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.llm.common import ship_package


def finite_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, vec, dim) that take part: no null vector, null component, NaN or infinity.
    Floats stay floats (half the bytes to move); any other number becomes a double."""
    vec = F.col(vector_col)
    if dict(df.dtypes)[vector_col] != "array<float>":
        vec = vec.cast("array<double>")
    usable = F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(usable).where("id is not null and size(vec) > 0").withColumn("dim", F.size("vec"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, dim)


Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def search_in_blocks(vectors: DataFrame, is_query: Column, search: Search, k: int, score_type: str, block_rows: int, query_rows: int) -> DataFrame:
    """The ``k`` best of every query over all rows: query_id, rank, vec_id, score.

    Rows are dealt into blocks of about ``block_rows`` by hash, queries into
    blocks of about ``query_rows``, and ``search(data_ids, data, query_ids,
    queries)`` answers each pair of blocks of one dimension in its own task; it
    returns (query position, data id, score) of at least the ``k`` best of the
    block for each query. The blocks' answers are merged by score, then smaller id.
    With n rows and q queries, n * q * (1 / block_rows + 1 / query_rows) vectors are
    shuffled, fewest for a task of given work when both blocks are of a size.
    """
    ship_package(vectors.sparkSession)
    # The running number spreads repeated rows with one id over the blocks.
    data = vectors.withColumn("_n", F.monotonically_increasing_id())
    queries = vectors.where(is_query).withColumn("_n", F.monotonically_increasing_id())
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, query_blocks = -(-counts["n"] // block_rows) or 1, -(-counts["q"] // query_rows) or 1

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id", "_n"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).drop("_n")

    left = dealt(data, "block", blocks, "query_block", query_blocks).groupBy("dim", "block", "query_block")
    right = dealt(queries, "query_block", query_blocks, "block", blocks).groupBy("dim", "block", "query_block")

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64() if score_type == "long" else pa.float64()]
        if not rows.num_rows or not asked.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
        dim = rows["dim"][0].as_py()
        ids, query_ids = rows["id"].to_numpy(), asked["id"].to_numpy()
        at, found, scores = search(ids, matrix(rows["vec"], dim), query_ids, matrix(asked["vec"], dim))
        return pa.Table.from_arrays([pa.array(query_ids[at], kinds[0]), pa.array(found, kinds[1]), pa.array(scores, kinds[2])], names=names)

    best = left.cogroup(right).applyInArrow(run, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_k(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best by score, then smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= floor)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


def frame(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, ids, scores) per query as three columns."""
    at = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int64)
    if not parts:
        return at, np.zeros(0, np.int64), np.zeros(0)
    return at, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
