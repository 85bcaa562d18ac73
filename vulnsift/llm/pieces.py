"""Words of a batch of texts as 64-bit hashes, and a table of what is known of each.

Splitting and hashing run over the UTF-8 bytes of a whole Arrow batch with
numpy, so a text operator touches Python objects only for words that its worker
has not met yet.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

BLOCK = 1 << 19
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.arange(256)
LETTER = ((_CODES | 32) >= 97) & ((_CODES | 32) <= 122) & (_CODES < 128)
PUNCT = (_CODES > 32) & (_CODES < 127) & ~LETTER & ~((_CODES >= 48) & (_CODES <= 57)) & (_CODES != 39)
NOT_LETTER = (_CODES < 128) & ~LETTER


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and odd multipliers)."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] = _PLAIN[97:123]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n of an odd base modulo 2^64, and those of its inverse."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, BLOCK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Pieces:
    """``starts``/``ends`` index ``buf``; text ``i`` has pieces ``offsets[i]:offsets[i+1]``."""

    buf: np.ndarray
    text_offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> bytes:
        return self.buf[self.text_offsets[i] : self.text_offsets[i + 1]].tobytes()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pa.compute.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        up, down = _powers(int(ends[j - 1] - base))
        sums = np.zeros(ends[j - 1] - base + 1, np.uint64)
        part = values[buf[base : ends[j - 1]]]
        part *= up[: len(part)]
        np.cumsum(part, out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        i = j
    return out


def split(texts: pa.Array, separators: np.ndarray = WHITE, *, fold: bool = False, punct_edges: bool = False, tile: bool = False) -> Pieces:
    """Cut texts at separator bytes.

    fold: A-Z hash as a-z. punct_edges: also cut between an ASCII letter and
    ASCII punctuation (the apostrophe is neither). tile: a separator opens the
    piece it precedes, so that the pieces cover the whole text.
    """
    buf, text_offsets = utf8(texts)
    n = len(buf)
    begins = text_offsets[:-1][np.diff(text_offsets) > 0]
    finishes = text_offsets[1:][np.diff(text_offsets) > 0] - 1
    gap = separators[buf]
    if tile:
        opens = gap.copy()
        opens[begins] = True
    else:
        opens = ~gap
        opens[1:] &= gap[:-1]
        opens[begins] = ~gap[begins]
    if punct_edges and n:
        letter, punct = LETTER[buf], PUNCT[buf]
        opens[1:] |= (letter[1:] & punct[:-1]) | (punct[1:] & letter[:-1])
    starts = np.flatnonzero(opens)
    if tile:
        ends = np.append(starts[1:], n) if len(starts) else starts
    else:
        closes = ~gap
        closes[:-1] &= gap[1:] | opens[1:]
        closes[finishes] = ~gap[finishes]
        ends = np.flatnonzero(closes) + 1
    hashes = _hash(buf, starts, ends, _FOLDED if fold else _PLAIN)
    return Pieces(buf, text_offsets, starts, ends, np.searchsorted(starts, text_offsets), hashes)


class WordTable:
    """Rows of what a worker knows of words, found by hash.

    ``learn`` gets the bytes of new words and appends one row for each to the
    owner's arrays; ``forget`` empties them. The table is emptied before it
    would pass ``limit`` words, so its memory is bounded and its content never
    affects a result.
    """

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None], limit: int = 600_000):
        self.learn, self.forget, self.limit = learn, forget, limit
        self._clear()

    def _clear(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.forget()

    def _missing(self, unique: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.ones(len(unique), bool)
        at = np.minimum(np.searchsorted(self.known, unique), len(self.known) - 1)
        return self.known[at] != unique

    def rows_of(self, p: Pieces) -> np.ndarray:
        """The row of every piece."""
        if not len(p.hashes):
            return np.zeros(0, np.int64)
        codes, unique = pd.factorize(p.hashes)
        missing = self._missing(unique)
        if missing.any():
            if len(self.known) + int(missing.sum()) > self.limit:
                self._clear()
                missing = self._missing(unique)
            first = np.empty(len(unique), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            at = first[missing]
            buf = p.buf
            self.learn([buf[s:e].tobytes() for s, e in zip(p.starts[at].tolist(), p.ends[at].tolist())])
            new = unique[missing]
            order = np.argsort(new, kind="stable")
            place = np.searchsorted(self.known, new[order])
            fresh = len(self.rows) + order
            self.known = np.insert(self.known, place, new[order])
            self.rows = np.insert(self.rows, place, fresh)
        return self.rows[np.searchsorted(self.known, unique)][codes]


class Ragged:
    """Growing rows of unequal length in one flat array."""

    def __init__(self, dtype: np.dtype):
        self.dtype = np.dtype(dtype)
        self.clear()

    def clear(self) -> None:
        self.flat, self.offsets = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows one after another, and the length of each."""
        begin, lengths = self.offsets[rows], self.offsets[rows + 1] - self.offsets[rows]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(begin - ends + lengths, lengths)], lengths


def per_text(lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of per-piece ``lengths`` as offsets of texts."""
    return np.concatenate([[0], np.cumsum(lengths)])[offsets]
