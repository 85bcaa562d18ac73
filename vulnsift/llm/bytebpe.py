"""Byte-level BPE with a hierarchical-bitmap rank queue (operator 7)."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vulnsift.llm.common import bounded_batches, held, map_batches
from vulnsift.llm.pieces import WHITE, Ragged, WordTable, per_text, split

# The pattern is part of the file format of the ranks (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space that isn't ASCII, as the pattern's \\s has it (fixed values).
WIDE_WHITE = {chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


DECODE_STEP = 1 << 16  # ids turned into bytes at once


def flat_ints(values: np.ndarray) -> array:
    """A numpy column as an array of 32-bit integers, which Python code reads without a list of objects."""
    out = array("i")
    out.frombytes(np.ascontiguousarray(values, np.int32).view(np.uint8))
    return out


class RankQueue:
    """Positions by merge rank, lowest rank first.

    A bucket per rank holds positions. A tree of 64-bit words marks the buckets
    that hold any: a word's bit says that the word or bucket below is not empty,
    so the next rank is one find-first-set for each level.
    """

    def __init__(self, ranks: int):
        self.buckets: list[array] = [array("i") for _ in range(ranks)]
        self.levels: list[list[int]] = []
        size = ranks
        while True:
            size = (size + 63) // 64
            self.levels.append([0] * size)
            if size == 1:
                break

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            at = rank
            for level in self.levels:
                word, bit = at >> 6, 1 << (at & 63)
                was = level[word]
                level[word] = was | bit
                if was:
                    break
                at = word
        bucket.append(position)

    def fill(self, rank: int, positions: array) -> None:
        self.push(rank, positions[0])
        self.buckets[rank].extend(positions[1:])

    def lowest(self) -> int:
        """The lowest rank with positions, or -1."""
        if not self.levels[-1][0]:
            return -1
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = at << 6 | (word & -word).bit_length() - 1
        return at

    def take(self, rank: int) -> array:
        """Empty a bucket; its positions in ascending order."""
        positions, self.buckets[rank] = self.buckets[rank], array("i")
        at = rank
        for level in self.levels:
            word = at >> 6
            level[word] &= ~(1 << (at & 63))
            if level[word]:
                break
            at = word
        if len(positions) > 1:
            np.frombuffer(positions, np.int32).sort()
        return positions


class ByteBpe:
    """Encoder and decoder for a file of ranks (``base64 rank`` per line)."""

    def __init__(self, path: str):
        import regex

        self.pattern = regex.compile(PATTERN)
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # The rank of two adjacent tokens is that of their concatenation.
        self.pairs = {
            self.ranks[t[:i]] << 32 | self.ranks[t[i:]]: r
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        }
        self.first = np.full((256, 256), -1, np.int32)
        for a in range(256):
            for b in range(256):
                self.first[a, b] = self.ranks.get(bytes((a, b)), -1)
        self.queue = RankQueue(self.size)
        self.words: dict[bytes, list[int]] = {}
        self.ids = Ragged(np.int32)
        self.table = WordTable(self._learn, self.ids.clear)

    def merge(self, words: list[bytes]) -> list[array]:
        """Ids of pre-tokens that are not tokens themselves.

        All words lie in one linked list with a barrier after each. The queue
        gives the lowest rank; its positions merge from left to right. A stale
        entry (the pair there has changed) is skipped. If a merge makes a pair of
        a lower rank, the rest of the bucket waits until that is done, so every
        word sees its lowest, leftmost pair first, as if merged by itself.

        List and buckets are flat 32-bit arrays: about 40 bytes for a byte at the most.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(words[0] if len(words) == 1 else b"".join(words), np.uint8)
        n = len(raw)
        last = np.cumsum(lengths) - 1
        initial = np.full(n, -1, np.int32)
        initial[:-1] = self.first[raw[:-1], raw[1:]]
        initial[last] = -1
        links = np.arange(1, n + 1, dtype=np.int32)
        links[last] = -1
        following = flat_ints(links)
        links = np.arange(-1, n - 1, dtype=np.int32)
        links[last[:-1] + 1] = -1
        before = flat_ints(links)
        del links
        ids, rank_at = flat_ints(self.byte_id[raw]), flat_ints(initial)
        queue, pairs = self.queue, self.pairs.get
        order = np.argsort(initial, kind="stable").astype(np.int32)
        order = order[np.searchsorted(initial, 0, sorter=order) :]
        cuts = np.flatnonzero(np.diff(initial[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            queue.fill(int(initial[group[0]]), flat_ints(group))
        del initial, order
        push = queue.push
        while (rank := queue.lowest()) >= 0:
            positions = queue.take(rank)
            for k, p in enumerate(positions):
                if rank_at[p] != rank:
                    continue
                q = following[p]
                ids[p] = rank
                rank_at[q] = -1
                ids[q] = -1
                after = following[q]
                following[p] = after
                lower = False
                if after >= 0:
                    before[after] = p
                    r = pairs(rank << 32 | ids[after], -1)
                    rank_at[p] = r
                    if r >= 0:
                        push(r, p)
                        lower = r < rank
                else:
                    rank_at[p] = -1
                b = before[p]
                if b >= 0:
                    r = pairs(ids[b] << 32 | rank, -1)
                    rank_at[b] = r
                    if r >= 0:
                        push(r, b)
                        lower |= r < rank
                if lower and k + 1 < len(positions):
                    queue.fill(rank, positions[k + 1 :])
                    break
        merged = np.frombuffer(ids, np.int32)
        kept = merged >= 0
        ends = np.cumsum(kept, dtype=np.int32)[last].tolist()
        merged = flat_ints(merged[kept])
        return [merged[a:b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[bytes]) -> dict[bytes, array]:
        """Ids of distinct pre-tokens."""
        found = {w: array("i", (r,)) for w in words if (r := self.ranks.get(w)) is not None}
        rest = [w for w in words if w not in found]
        step: list[bytes] = []
        held = 0
        for w in rest:
            step.append(w)
            held += len(w)
            if held > 2_000_000:
                found.update(zip(step, self.merge(step)))
                step, held = [], 0
        if step:
            found.update(zip(step, self.merge(step)))
        return found

    def _pre_tokens(self, text: bytes) -> list[bytes]:
        return [m.encode() for m in self.pattern.findall(text.decode())]

    def _learn(self, pieces: list[bytes]) -> None:
        cut = [[x] if x[:1] == b" " and x[1:].isalpha() or x.isalpha() else self._pre_tokens(x) for x in pieces]
        known = self.encode_words(list(dict.fromkeys(w for ws in cut for w in ws)))
        rows = [known[ws[0]] if len(ws) == 1 else [i for w in ws for i in known[w]] for ws in cut]
        self.ids.extend(
            np.fromiter((i for r in rows for i in r), np.int32), np.fromiter(map(len, rows), np.int64, len(rows))
        )

    def _odd(self, buf: np.ndarray, text_offsets: np.ndarray) -> np.ndarray:
        """Texts in which a run of white space may reach past a piece: three or more
        in a row, two at the end of the text, or any two of which one isn't ASCII."""
        white = WHITE[buf]
        hits = np.zeros(len(buf) + 1, np.int64)
        if len(buf) > 2:
            hits[3:] = white[:-2] & white[1:-1] & white[2:]
        leads = np.flatnonzero(np.isin(buf, (0xC2, 0xE1, 0xE2, 0xE3)))
        wide = [(i, i + 2 + (buf[i] != 0xC2)) for i in leads.tolist() if buf[i : i + 2 + (buf[i] != 0xC2)].tobytes() in WIDE_WHITE]
        closes = {end for _, end in wide}
        opens = {begin for begin, _ in wide}
        for begin, end in wide:
            if begin in closes or end in opens or begin and white[begin - 1] or end < len(buf) and white[end]:
                hits[begin + 1] = 1
        runs = np.cumsum(hits)
        begin, end = text_offsets[:-1], text_offsets[1:]
        odd = runs[end] > runs[begin]
        two = end - begin >= 2
        odd[two] |= white[end[two] - 1] & white[end[two] - 2]
        return odd

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text in them; null counts as empty."""
        p = split(texts, punct_edges=True, tile=True)
        odd = np.flatnonzero(self._odd(p.buf, p.text_offsets))
        flat, lengths = self.ids.take(self.table.rows_of(p)) if len(p.starts) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        offsets = per_text(lengths, p.offsets)
        if not len(odd):
            return flat, offsets
        parts = [flat[offsets[i] : offsets[i + 1]] for i in range(len(offsets) - 1)]
        for i in odd.tolist():
            words = self._pre_tokens(p.text(i))
            known = self.encode_words(list(dict.fromkeys(words)))
            parts[i] = np.frombuffer(b"".join(known[w] for w in words), np.int32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def decode(self, ids: np.ndarray) -> bytes:
        steps = (ids[i : i + DECODE_STEP].tolist() for i in range(0, len(ids), DECODE_STEP))
        return b"".join(b"".join(map(self.tokens.__getitem__, step)) for step in steps)


def coder(path: str) -> ByteBpe:
    """The worker's coder for a file of ranks."""
    return held("byte-bpe", path, lambda: ByteBpe(path))


def _packed(bpe: ByteBpe, texts: pa.Array) -> list[bytes]:
    flat, offsets = bpe.encode(texts)
    wide = flat.astype("<u4")
    return [wide[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def encode_documents(docs: DataFrame, ranks: str) -> DataFrame:
    """``docs`` (doc_id, text) with the token ids of every whole text: doc_id, ids
    (packed little-endian unsigned 32-bit integers).

    Null and empty texts have no ids; repeated rows and null ids are encoded like
    any other; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_batches(batches, "text"):
            ids = _packed(coder(ranks), batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, "doc_id long, ids binary")


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """``docs`` encoded, and the ids decoded again by the same worker: doc_id, ids,
    bytes. Cases as in ``encode_documents``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks)
        for batch in bounded_batches(batches, "text"):
            ids = _packed(bpe, batch.column("text"))
            out = [bpe.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, "doc_id long, ids binary, bytes binary")


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """Rows of packed ids (doc_id, ids) with the bytes that they stand for: doc_id, ids, bytes.
    Null ids have null bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks)
        for batch in bounded_batches(batches, "ids"):
            out = [None if x is None else bpe.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, bytes binary")
