"""Cost-balanced packing of token sequences (operator 9)."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.common import bounded_batches, map_batches, stored
from vulnsift.llm.wordbpe import encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
POOLS = 1 << 62  # sequence ids from here on are those of pooled remainders
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def piece_cost(length: int, linear: float, quadratic: float) -> float:
    """Estimated cost of one piece: per-token work plus attention over its pairs."""
    return linear * length + quadratic * length * length


def pack(lengths: list[int], capacity: int, linear: float = 1.0, quadratic: float = 1.0 / 1024, split_rest: bool = True) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents by token count.

    Sequences: as many full ones as the tokens fill, and for what is left one for
    each power of two in it, so that none has padding (or a single one, the last, if
    ``split_rest`` is false). Documents go longest first
    to the sequence of the lowest cost with room. What doesn't fit there is cut
    off and queues again by its length.
    """
    total = sum(lengths)
    rooms = [capacity] * (total // capacity)
    left = total % capacity
    rooms += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1] if split_rest else [left] * (left > 0)
    cost = [0.0] * len(rooms)
    fill = [0] * len(rooms)
    # A short sequence starts as if its missing room were taken, so that costs compare by capacity.
    cheapest = [(piece_cost(capacity - room, linear, quadratic), k) for k, room in enumerate(rooms)]
    for base, k in cheapest:
        cost[k] = base
    heapq.heapify(cheapest)
    waiting = [(-n, doc, 0) for doc, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    out = []
    while waiting:
        negative, doc, start = heapq.heappop(waiting)
        length = -negative
        _, k = heapq.heappop(cheapest)  # every sequence in the heap has room
        take = min(length, rooms[k] - fill[k])
        out.append((doc, start, take, k, fill[k]))
        fill[k] += take
        cost[k] += piece_cost(take, linear, quadratic)
        if fill[k] < rooms[k]:
            heapq.heappush(cheapest, (cost[k], k))
        if take < length:
            heapq.heappush(waiting, (take - length, doc, start + take))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(COLUMNS)
    arrays = [pa.array(c, pa.binary() if name == "ids" else pa.int64()) for name, c in zip(COLUMNS, columns)]
    return pa.RecordBatch.from_arrays(arrays, names=COLUMNS)


def _packed(ids: list, docs: list[int | None], capacity: int, base: int, costs: tuple[float, float]) -> pa.RecordBatch:
    """The full sequences of a group; what is left has the negative ``-1 - base`` for one."""
    rows = pack([len(x) for x in ids], capacity, *costs, split_rest=False)
    full = sum(map(len, ids)) // capacity
    return _batch([
        (docs[d], start, n, ids[d][start : start + n].astype("<u4").tobytes(), len(ids[d]), base + k if k < full else -1 - base, offset)
        for d, start, n, k, offset in rows
    ])


def _pooled(capacity: int, costs: tuple[float, float]):
    def run(pool: tuple, pieces: pa.Table) -> pa.Table:
        """The left pieces of many groups packed again."""
        own = {c: pieces[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")}
        base = POOLS | pool[0].as_py() << 32
        return pa.Table.from_batches([_batch([
            (own["doc_id"][p], own["start"][p] + start, n, own["ids"][p][4 * start : 4 * (start + n)], own["doc_tokens"][p], base + k, offset)
            for p, start, n, k, offset in pack(pieces["length"].to_pylist(), capacity, *costs)
        ])])

    return run


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    capacity: int = 2048,
    group_tokens: int = 1 << 20,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
) -> DataFrame:
    """Pack the token ids of ``docs`` (doc_id, text) into sequences of ``capacity``.

    Each task tokenises its rows and packs them in groups of at least
    ``group_tokens`` tokens (its last group may be smaller), so a task holds one group at
    a time. What a group has left, less than a sequence, goes to a pool of about
    ``group_tokens`` tokens and is packed there with what other groups left, whichever tasks
    they are of; nothing else is shuffled. Sequences are full, or, the last few of a pool, have
    a power of two of tokens; none is padded. Null text counts as empty: a
    document of the end id alone. A piece carries its ids as packed little-endian
    unsigned 32-bit integers. Repeated rows and null ids are packed like
    any other row; an empty table gives no pieces; other columns are ignored.
    Sequence ids are unique over the result: the task's number and a running
    number in it, or the pool's. Costs are even within a group and a pool.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        base = TaskContext.get().partitionId() << 40
        ids: list[np.ndarray] = []
        docs_: list[int | None] = []
        held = 0
        end = np.asarray([end_id], bpe.dtype)
        for batch in bounded_batches(batches, "text"):
            flat, offsets = bpe.encode(batch.column("text"))
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids.append(np.concatenate([flat[offsets[k] : offsets[k + 1]], end]))
                docs_.append(doc)
                held += len(ids[-1])
                if held >= group_tokens:
                    yield _packed(ids, docs_, capacity, base, (linear, quadratic))
                    base += held // capacity + capacity.bit_length()
                    ids, docs_, held = [], [], 0
        if ids:
            yield _packed(ids, docs_, capacity, base, (linear, quadratic))

    pieces = stored(map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, SCHEMA), "pieces")
    left = pieces.where("sequence_id < 0")
    pools = max(1, -(-(left.agg(F.sum("length")).first()[0] or 0) // group_tokens))
    pool = F.pmod(F.xxhash64("sequence_id"), F.lit(pools)).alias("pool")
    again = left.groupBy(pool).applyInArrow(_pooled(capacity, (linear, quadratic)), SCHEMA)
    return pieces.where("sequence_id >= 0").unionAll(again)
