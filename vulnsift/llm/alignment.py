"""Tokens of two tokenizers aligned by the byte offsets where both end (operator 12).

Both tokenizers cover the same bytes (a space and the text), so each token has a byte
end; where a token of A and one of B end together, the text can be cut. The cuts are found
by divide and conquer, for all texts of a batch at once: of an interval, the ends of A
nearest its middle are looked up by bisection among those of B, in a window that
doubles until one is shared; the interval is cut there and both halves go on. An
interval without a shared end is a group, the least piece in which the two agree.

A token of A and one of B that end a group together are linked. How often the corpus
links a pair of ids is counted in blocks: a block of documents lists its different pairs
once, gets back their counts in the corpus, and hands them to its documents. So a pair
that is everywhere costs a row for each block, never one for each document.

Words are encoded once for each worker (``pieces.WordTable``). Texts are cut at
spaces after a letter or sign, where neither tokenizer goes on: A cuts there before it
looks at anything, and no piece of B goes on after a space (both checked).

Odd input: a text that is null or empty, or whose tokens of A or B aren't the bytes of
the space and the text (B maps some signs to others), has no tokens: counts are 0 and ``groups`` is empty.
Repeated rows are rows of their own; other columns play no part unless kept.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnsift.llm.common import bounded_batches, held, map_batches, ship_package
from vulnsift.llm.pieces import WHITE, _PLAIN, Pieces, Ragged, WordTable, _hash, per_text, utf8
from vulnsift.llm.wordbpe import byte_letters

ALIGNED = T.StructType([
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("groups", T.StringType()), T.StructField("block", T.LongType()),
    T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
    T.StructField("block_a", T.ArrayType(T.IntegerType())), T.StructField("block_b", T.ArrayType(T.IntegerType())),
    T.StructField("block_n", T.ArrayType(T.LongType())),
])
_SPACE = "▁"  # how a sentencepiece model writes a space


def _ragged(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... for each row, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + lengths, lengths)


def _cut_nearest(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval ``low:high`` of A's ends the shared one nearest the middle, or -1."""
    middle, cut = (low + high) >> 1, np.full(len(low), -1)
    open_, reach = np.arange(len(low)), 0
    while len(open_):
        m = middle[open_]
        left, right = np.maximum(low[open_], m - reach), np.minimum(high[open_], m + reach + 1)
        lengths = right - left
        probe = _ragged(left, lengths)
        found = np.minimum(np.searchsorted(ends_b, ends_a[probe]), len(ends_b) - 1)
        shared = ends_b[found] == ends_a[probe]
        away = probe - np.repeat(m, lengths)
        rank = np.where(shared, 2 * np.abs(away) + (away > 0), np.iinfo(np.int64).max)
        best = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        hit = best < np.iinfo(np.int64).max
        step = best[hit] >> 1
        cut[open_[hit]] = m[hit] + np.where(best[hit] & 1, step, -step)
        whole = lengths == high[open_] - low[open_]
        open_, reach = open_[~hit & ~whole], 2 * reach + 1
    return cut


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, offsets_a: np.ndarray, offsets_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last tokens of all groups, as indexes of A's tokens and of B's.

    ``ends`` rise over all texts; the tokens of text i lie between ``offsets[i]``
    and ``offsets[i + 1]``, and the last ones of A and B end together.
    """
    has = offsets_a[1:] > offsets_a[:-1]
    low_a, high_a = offsets_a[:-1][has], offsets_a[1:][has] - 1
    low_b, high_b = offsets_b[:-1][has], offsets_b[1:][has] - 1
    cuts_a, cuts_b = [high_a], [high_b]
    while len(low_a):
        wide = (high_a > low_a) & (high_b > low_b)
        low_a, high_a, low_b, high_b = low_a[wide], high_a[wide], low_b[wide], high_b[wide]
        if not len(low_a):
            break
        cut = _cut_nearest(ends_a, ends_b, low_a, high_a)
        hit = cut >= 0
        cut, low_a, high_a, low_b, high_b = cut[hit], low_a[hit], high_a[hit], low_b[hit], high_b[hit]
        at = np.searchsorted(ends_b, ends_a[cut])
        cuts_a.append(cut)
        cuts_b.append(at)
        low_a, high_a = np.concatenate([low_a, cut + 1]), np.concatenate([cut, high_a])
        low_b, high_b = np.concatenate([low_b, at + 1]), np.concatenate([at, high_b])
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class CrossTokens:
    """Both tokenizers, the bytes of their tokens and what is known of words."""

    def __init__(self, a_file: str, b_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        rules = json.loads(self.a.to_str())
        cutter = rules.get("pre_tokenizer") or {}
        if rules.get("normalizer") or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True) or cutter.get("add_prefix_space"):
            raise ValueError(f"{a_file} isn't a byte-level vocabulary that cuts words by pattern")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte_of = {chr(c): b for b, c in byte_letters().items()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError(f"{b_file} has pieces that go on after a space")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        if not all(self.b_bytes) or not all(self.a_bytes[i] for i in vocab.values()):
            raise ValueError("a vocabulary with an empty token")
        self.a_length, self.b_length = (np.asarray([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.ids_a, self.ids_b, self.faithful = Ragged(np.int32), Ragged(np.int32), Ragged(np.int32)
        self.table = WordTable(self._learn, self._forget, limit=400_000)
        # How a group's tokens are written: within and at the end of A's, of B's.
        numbers = [[str(i) for i in range(len(t))] for t in (self.a_bytes, self.b_bytes)]
        self.written = np.asarray([n + sep for ns, seps in zip(numbers, (",|", ",;")) for sep in seps for n in ns], object)

    def _forget(self) -> None:
        for r in (self.ids_a, self.ids_b, self.faithful):
            r.clear()

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = [x if t != " " else [self.b.piece_to_id(_SPACE)] for t, x in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1))]
        same = [b"".join([self.a_bytes[i] for i in x]) == w == b"".join([self.b_bytes[i] for i in y]) for w, x, y in zip(words, a, b)]
        for kept, ids in ((self.ids_a, a), (self.ids_b, b)):
            kept.extend(np.asarray([i for x in ids for i in x], np.int32), np.asarray([len(x) for x in ids], np.int64))
        self.faithful.extend(np.asarray(same, np.int32), np.ones(len(words), np.int64))

    def split(self, texts: pa.Array) -> Pieces:
        """Words of a space and each text, each with the space before it."""
        joined = pa.compute.binary_join_element_wise(pa.scalar(" ", texts.type), pa.compute.fill_null(texts, ""), pa.scalar("", texts.type))
        buf, text_offsets = utf8(joined)
        opens = buf == 32
        # A letter of U+00C0 to U+00FF is C3 and a byte; other signs beyond ASCII might be spaces.
        latin = np.zeros(len(buf), bool)
        latin[1:] = buf[:-1] == 0xC3
        solid = (~WHITE[buf] & (buf > 32) & (buf < 127)) | latin
        opens[1:] &= solid[:-1]
        opens[text_offsets[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(buf)) if len(starts) else starts
        return Pieces(buf, text_offsets, starts, ends, np.searchsorted(starts, text_offsets), _hash(buf, starts, ends, _PLAIN))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and text offsets of A, then of B; none for texts that either one changes."""
        p = self.split(texts)
        rows = self.table.rows_of(p)
        bad = np.add.reduceat(1 - self.faithful.flat[rows], p.offsets[:-1]) > 0 if len(rows) else np.zeros(0, bool)
        bad |= np.diff(p.text_offsets) == 1  # the space of an empty text
        words = np.diff(p.offsets)
        rows = rows[np.repeat(~bad, words)]
        offsets = np.concatenate([[0], np.cumsum(np.where(bad, 0, words))])
        out = []
        for ids in (self.ids_a, self.ids_b):
            flat, lengths = ids.take(rows)
            out += [flat, per_text(lengths, offsets)]
        return tuple(out)

    def align(self, texts: pa.Array, block: int) -> pa.RecordBatch:
        ids_a, at_a, ids_b, at_b = self.encode(texts)
        ends_a, ends_b = np.cumsum(self.a_length[ids_a]), np.cumsum(self.b_length[ids_b])
        cut_a, cut_b = shared_cuts(ends_a, ends_b, at_a, at_b) if len(ids_a) else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(cut_a, at_a)  # groups before each text
        groups = self._groups(ids_a, ids_b, cut_a, cut_b, at_a + at_b)
        width = len(self.b_bytes)
        codes, unique = pd.factorize(ids_a[cut_a].astype(np.int64) * width + ids_b[cut_b])
        text_of = np.repeat(np.arange(len(texts)), np.diff(first))
        own, times = np.unique(text_of * max(1, len(unique)) + codes, return_counts=True)
        begin = np.searchsorted(own, np.arange(len(texts) + 1) * max(1, len(unique)))
        local = (own % max(1, len(unique))).astype("<i4")
        times = times.astype("<i4")
        empty = [None] * (len(texts) - 1)
        lists = [unique // width, unique % width, np.bincount(codes, minlength=len(unique))]
        kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return [
            pa.array(np.diff(at_a)), pa.array(np.diff(at_b)), pa.array(np.diff(first)), pa.array(groups, pa.string()),
            pa.array(np.full(len(texts), block)),
            *[pa.array([x[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:])], pa.binary()) for x in (local, times)],
            *[pa.array([x, *empty], kind) for x, kind in zip(lists, kinds)],
        ]

    def _groups(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, offsets: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        code_a, code_b = ids_a.astype(np.int64), ids_b.astype(np.int64) + 2 * n_a
        code_a[cut_a] += n_a
        code_b[cut_b] += n_b
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        codes = np.empty(len(code_a) + len(code_b), np.int64)
        codes[np.arange(len(code_a)) + np.repeat(cut_b + 1 - size_b, size_a)] = code_a
        codes[np.arange(len(code_b)) + np.repeat(cut_a + 1, size_b)] = code_b
        return ["".join(self.written[codes[i:j]].tolist())[:-1] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def align_documents(docs: DataFrame, a_file: str, b_file: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row for each document, map-side: the ``keep`` columns, ``n_a, n_b, n_groups`` and
    ``groups`` (``a1,a2|b1;a3|b2,b3``, ids of A and B in each group), and, for
    ``with_link_counts``, its different links as places in its block's list (the
    first row of a block holds the list). Store it before that: blocks are numbered by task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = held("cross-tokens", (a_file, b_file), lambda: CrossTokens(a_file, b_file))
        task = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(bounded_batches(batches, "text")):
            kept = batch.select(keep)
            columns = both.align(batch.column("text"), task + i)
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*keep, *ALIGNED.names])

    fields = [docs.schema[k] for k in keep]
    return map_batches(docs.select(*keep, "text"), run, T.StructType([*fields, *ALIGNED.fields]))


def corpus_counts(aligned: DataFrame) -> DataFrame:
    """``a, b`` (linked ids), ``n`` (links of the corpus) and ``best``, whether no other
    token of A is linked with b more often."""
    counts = _block_pairs(aligned).groupBy("a", "b").agg(F.sum("n").alias("n"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    # At most a row for each piece of B's vocabulary.
    return counts.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _block_pairs(aligned: DataFrame) -> DataFrame:
    listed = aligned.where(F.col("block_a").isNotNull())
    rows = listed.select("block", F.posexplode(F.arrays_zip("block_a", "block_b", "block_n")).alias("place", "p"))
    return rows.select("block", "place", F.col("p.block_a").alias("a"), F.col("p.block_b").alias("b"), F.col("p.block_n").alias("n"))


def with_link_counts(aligned: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of a stored ``align_documents`` and ``n_links``, ``n_best`` (links that
    the corpus holds as often as any with that token of B) and ``count_sum`` (over the
    links, how often the corpus holds them)."""
    counted = _block_pairs(aligned).drop("n").join(corpus_counts(aligned), ["a", "b"]).select(F.col("block").alias("of"), "place", "n", "best")
    docs = aligned.select("block", "pairs", "times", *keep)
    fields = [aligned.schema[k] for k in keep]
    schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in ("n_links", "n_best", "count_sum")]])

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        n, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        place = pairs["place"].to_numpy()
        n[place], best[place] = pairs["n"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
        own = [np.frombuffer(x, "<i4") for x in docs["pairs"].to_pylist()]
        times = np.concatenate([np.frombuffer(x, "<i4") for x in docs["times"].to_pylist()]).astype(np.int64)
        flat, offsets = np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])
        sums = [np.concatenate([[0], np.cumsum(x)])[offsets] for x in (times, times * best[flat], times * n[flat])]
        return pa.Table.from_arrays([*[docs[k] for k in keep], *[pa.array(np.diff(s)) for s in sums]], schema.names)

    ship_package(aligned.sparkSession)
    return docs.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(run, schema)
