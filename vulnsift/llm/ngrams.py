"""Hashed n-grams of many words at once, by bytes or characters, and bounded training samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.pieces import mix


WORDS_AT_ONCE = 20_000


def padded(words: list[bytes], characters: bool) -> tuple[np.ndarray, np.ndarray]:
    """The signs of the words one after another, each word with a start and an end mark,
    and their numbers of signs."""
    joined = b"".join(b"\x02" + w + b"\x03" for w in words)
    if not characters:
        return np.frombuffer(joined, np.uint8).astype(np.uint64), np.fromiter(map(len, words), np.int64, len(words)) + 2
    buf = np.frombuffer(joined, np.uint8)
    begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)])
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # first bytes of characters
    return np.frombuffer(joined.decode().encode("utf-32-le"), "<u4").astype(np.uint64), np.diff(points[begins])


def grams(words: list[bytes], sizes: tuple[int, ...], buckets: int, characters: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size: the bucket of the n-gram that begins at every sign (byte, or
    character) of the padded words, whether it lies in its word, and the word's number.
    ``buckets`` is a power of two."""
    raw, lengths = padded(words, characters)
    owner = np.repeat(np.arange(len(words)), lengths)
    room = np.cumsum(lengths)[owner] - np.arange(len(raw))
    rolling = np.zeros(len(raw), np.uint64)
    for n in range(1, max(sizes) + 1):
        last = np.zeros(len(raw), np.uint64)
        last[: len(raw) - n + 1] = raw[n - 1 :]
        rolling = rolling * np.uint64(0x100000001B3) + last + np.uint64(n)
        if n in sizes:
            yield (mix(rolling) & np.uint64(buckets - 1)).astype(np.int64), room >= n, owner


def gram_sums(words: list[bytes], sizes: tuple[int, ...], weights: np.ndarray, characters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Per word the sum of ``weights[bucket]`` (a row for each bucket) over its
    n-grams, and their number."""
    if len(words) > WORDS_AT_ONCE:
        parts = [gram_sums(words[i : i + WORDS_AT_ONCE], sizes, weights, characters) for i in range(0, len(words), WORDS_AT_ONCE)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    sums, counts = np.zeros((len(words), weights.shape[1])), np.zeros(len(words), np.int64)
    ends = np.cumsum(padded(words, characters)[1])
    begins = np.concatenate([[0], ends[:-1]])
    for bucket, inside, owner in grams(words, sizes, len(weights), characters):
        running = np.zeros((len(bucket) + 1, weights.shape[1]))
        np.cumsum(np.where(inside[:, None], weights[bucket], 0), axis=0, out=running[1:])
        sums += running[ends] - running[begins]
        counts += np.bincount(owner[inside], minlength=len(words))
    return sums, counts


def sample_rows(rows: DataFrame, label: str, per_label: int) -> tuple[DataFrame, dict]:
    """About ``per_label`` rows of each label (and at most four times as many in
    all as that times the labels), by a hash of doc_id; and the number of all rows
    by label."""
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    keep: Column = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (draw < F.lit(int(min(1.0, per_label / n) * (1 << 30)))))
    return rows.where(keep).limit(4 * per_label * max(1, len(counts))), counts


def collected(rows: DataFrame, label: str, per_label: int, longest: int) -> list[tuple]:
    """(text, label) of sampled rows of at most ``longest`` characters, in a fixed
    order, and at most twice ``per_label`` of a label."""
    out, taken = [], {}
    usable = rows.where(F.length("text") <= longest).select("text", label, "doc_id")
    for r in sorted(usable.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"])):
        taken[r[label]] = taken.get(r[label], 0) + 1
        if taken[r[label]] <= 2 * per_label:
            out.append((r["text"], r[label]))
    return out
