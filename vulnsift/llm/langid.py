"""Language identification by script ranges and Viterbi over words (operator 4)."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.common import bounded_batches, crc_mod, held, map_batches
from vulnsift.llm.ngrams import collected, gram_sums, grams, sample_rows
from vulnsift.llm.pieces import NOT_LETTER, WordTable, split

# First code points of ranges of one script (fixed values of the Unicode blocks).
SCRIPT_STARTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x31A0, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
    (0x20000, "han"), (0x323B0, "other"),
]
_STARTS = [s for s, _ in SCRIPT_STARTS]
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 17
FLOOR = -6.0  # the least that one word says against a language
SWITCH = 15.0  # penalty of a change of language
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,begin:long,end:long>>"


def script(ch: str) -> str:
    at = bisect_right(_STARTS, ord(ch)) - 1
    return SCRIPT_STARTS[at][1] if at >= 0 else "other"


def _letters(word: bytes) -> tuple[str, int]:
    """Script of a word (that of its first letter) and its number of letters."""
    if word.isascii():
        return "latin", len(word)
    alphabetic = [c for c in word.decode() if c.isalpha()]
    return (script(alphabetic[0]) if alphabetic else "other"), len(alphabetic)


@dataclass(eq=False)
class LanguageModel:
    """langs: sorted labels. weights: log-probability of each n-gram bucket by
    language. scripts: script -> languages written in it. shares: prior of each."""

    langs: list[str]
    weights: np.ndarray
    scripts: dict[str, list[int]]
    shares: np.ndarray


def train(docs: DataFrame, per_language: int = 1200, longest: int = 20_000) -> LanguageModel:
    """Naive-Bayes n-gram weights from about ``per_language`` labelled documents of
    each language, of at most ``longest`` characters (``docs``: doc_id, text, lang)."""
    rows, counts = sample_rows(docs.where("text is not null"), "lang", per_language)
    sample = collected(rows, "lang", per_language, longest)
    langs = sorted(counts)
    seen = np.full((BUCKETS, max(len(langs), 1)), 0.1)
    by_script: dict[str, np.ndarray] = {}
    for k, lang in enumerate(langs):
        texts = pa.array([t for t, own in sample if own == lang], pa.string())
        p = split(texts, NOT_LETTER, fold=True)
        _, first, times = np.unique(p.hashes, return_index=True, return_counts=True)
        words = [p.buf[s:e].tobytes().lower() for s, e in zip(p.starts[first].tolist(), p.ends[first].tolist())]
        if not words:
            continue
        weight = np.sqrt(times)  # frequent words count, but don't drown the rest
        for bucket, inside, owner in grams(words, SIZES, BUCKETS):
            seen[:, k] += np.bincount(bucket[inside], weight[owner[inside]], BUCKETS)
        for word, n in zip(words, times.tolist()):
            name, letters = _letters(word)
            by_script.setdefault(name, np.zeros(len(langs)))[k] += letters * n
    weights = np.log(seen / seen.sum(axis=0))
    total = sum(by_script.values()) if by_script else np.zeros(len(langs))
    scripts = {s: [k for k in range(len(langs)) if n[k] > 0.01 * total[k]] for s, n in by_script.items()}
    every = sum(counts.values())
    return LanguageModel(langs, weights.astype(np.float32), {s: ks for s, ks in scripts.items() if ks}, np.array([counts[x] / every for x in langs]))


def viterbi(scores: np.ndarray, begins: np.ndarray, ends: np.ndarray, penalty: float) -> list[np.ndarray]:
    """For several texts (rows ``begins[i]:ends[i]`` of ``scores``, none empty), the
    labels of their words that maximise the sum of scores less ``penalty`` for each
    change. The texts advance together, word by word."""
    k = scores.shape[1]
    lengths = ends - begins
    order = np.argsort(-lengths, kind="stable")
    at, lengths = begins[order], lengths[order]
    running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # texts longer than t
    best, keep, back = scores[at].copy(), np.arange(k), []
    for t in range(1, len(running)):
        m = running[t]
        own = best[:m]
        top = own.argmax(axis=1)
        moved = own[np.arange(m), top][:, None] - penalty
        stay = own >= moved
        back.append(np.where(stay, keep, top[:, None]).astype(np.int16))
        best[:m] = np.where(stay, own, moved) + scores[at[:m] + t]
    now = best.argmax(axis=1)
    paths = [np.empty(n, np.int64) for n in lengths]
    for i in range(len(paths)):
        paths[i][-1] = now[i]
    for t in range(len(running) - 1, 0, -1):
        m = running[t]
        now[:m] = back[t - 1][np.arange(m), now[:m]]
        for i in range(m):
            paths[i][t - 1] = now[i]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(paths)
    for place, path in zip(order.tolist(), paths):
        out[place] = path
    return out


def one_language_suffices(gains: np.ndarray, penalty: float) -> bool:
    """Whether labelling all words with the best single language is optimal.

    ``gains``: running sums (from 0) of each language's lead over it. With m the
    most that any stretch gains, and p and s the most at the start and the end, a
    run of j other spans gains at most j*m for j + 1 changes inside the text, at
    most p + (j-1)*m for j changes at its start (or the same with s at its end),
    and p + s + (j-2)*m for j - 1 changes if it is the whole text.
    """
    most = float((gains - np.minimum.accumulate(gains, axis=0)).max())
    start, end = float(gains.max()), float((gains[-1] - gains.min(axis=0)).max())
    return most <= penalty and start + end <= penalty


class Labeller:
    """Scores words (each learned once by a worker) and labels texts."""

    def __init__(self, model: LanguageModel, penalty: float = SWITCH):
        self.model, self.penalty = model, penalty
        self.table = WordTable(self._learn, self._forget)

    def _forget(self) -> None:
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        model = self.model
        lower = [w.lower() for w in words]
        sums, counts = gram_sums(lower, SIZES, model.weights)
        sums /= np.maximum(counts, 1)[:, None] / np.sqrt(np.maximum(counts, 1))[:, None]
        kinds = [_letters(w) for w in lower]
        shut = {}
        for name in {k for k, _ in kinds}:
            candidates = model.scripts.get(name, [])
            shut[name] = [k for k in range(len(model.langs)) if candidates and k not in candidates]
        for i, (name, letters) in enumerate(kinds):
            if name != "latin" or shut[name]:
                if name not in model.scripts:
                    sums[i] = 0  # a script of no learned language says nothing
                else:
                    sums[i, shut[name]] = -np.inf
            if not letters:
                sums[i] = 0
        best = sums.max(axis=1, keepdims=True)
        # A language that the script rules out costs more than a switch to another and back.
        behind = np.where(np.isneginf(sums), -2 * self.penalty - 1, np.maximum(sums - best, FLOOR))
        self.scores = np.concatenate([self.scores, behind.astype(np.float32)])
        self.letters = np.concatenate([self.letters, np.array([n for _, n in kinds], np.int64)])

    def label(self, texts: pa.Array) -> Iterator[tuple[str, float, list[tuple[str, int, int]]]]:
        """Per text: language, score, spans (language, begin, end in bytes)."""
        if not self.model.langs:
            yield from [(UNKNOWN, 0.0, [])] * len(texts)
            return
        p = split(texts, NOT_LETTER, fold=True)
        rows = self.table.rows_of(p)
        scores, letters = self.scores[rows].astype(np.float64), self.letters[rows]
        langs, offsets = self.model.langs, p.offsets
        running = np.concatenate([np.zeros((1, len(langs))), np.cumsum(scores, axis=0)])
        n = len(offsets) - 1
        totals = running[offsets[1:]] - running[offsets[:-1]]
        top = (totals + 1e-6 * self.model.shares).argmax(axis=1)
        worded = np.concatenate([[0], np.cumsum(letters)])[offsets]
        mixed = {}
        for i in range(n):
            a, b = int(offsets[i]), int(offsets[i + 1])
            if len(langs) > 1 and worded[i + 1] > worded[i]:
                lead = running[a : b + 1] - running[a : b + 1, top[i], None]
                if not one_language_suffices(lead - lead[0], self.penalty):
                    mixed[i] = None
        at = np.fromiter(mixed, np.int64, len(mixed))
        mixed = dict(zip(at.tolist(), viterbi(scores, offsets[at], offsets[at + 1], self.penalty)))
        for i in range(n):
            a, b = int(offsets[i]), int(offsets[i + 1])
            if worded[i + 1] == worded[i]:
                yield UNKNOWN, 0.0, []
                continue
            path = mixed.get(i)
            if path is None:
                path = np.full(b - a, top[i])
            changes = np.flatnonzero(np.diff(path)) + 1
            begins, ends = [0, *changes.tolist()], [*changes.tolist(), b - a]
            by_lang = np.bincount(path, letters[a:b], len(langs))
            found = int((by_lang + 1e-6 * self.model.shares).argmax())
            own = totals[i] if len(changes) == 0 else scores[a:b][path == found].sum(axis=0)
            others = np.delete(own, found)
            margin = min(30.0, max(-30.0, float(own[found] - others.max()))) if len(others) else 30.0
            score = float(by_lang[found] / by_lang.sum()) / (1 + math.exp(-margin))
            base = int(p.text_offsets[i])
            spans = [(langs[int(path[s])], int(p.starts[a + s]) - base, int(p.ends[a + e - 1]) - base) for s, e in zip(begins, ends)]
            yield langs[found], score, spans


def _held(shared) -> Labeller:
    """The worker's labeller for a broadcast model."""
    return held("language", shared.value, lambda: Labeller(shared.value))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The language of every whole text of ``docs`` (doc_id, text): doc_id,
    lang_pred, score, spans.

    Script ranges narrow a word's candidate languages, the word's n-grams score
    them, and Viterbi with a penalty for each change labels spans; the language
    with most letters names the text. ``score`` is its share of the letters times
    how sure the words of its spans are of it. Null, empty and letterless texts are ``und``
    with score 0 and no spans; equal languages go to the one with more training
    labels; repeated rows and null ids are labelled like any other; without any
    training label all is ``und``; an empty table gives no rows; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed number of buckets x languages

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
        for batch in bounded_batches(batches, "text"):
            found = list(_held(shared).label(batch.column("text")))
            spans = [[{"lang": x, "begin": b, "end": e} for x, b, e in s] for _, _, s in found]
            arrays = [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "spans"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, SCHEMA)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with a score of at least
    ``least``; all columns as they are. Cases as in ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_batches(batches, "text"):
            found = _held(shared).label(batch.column("text"))
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score, _ in found], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def train_on_folds(docs: DataFrame) -> LanguageModel:
    """Train on the documents whose crc32(doc_id) modulo 5 isn't 0."""
    training = docs.where(crc_mod(F.col("doc_id"), 5) != 0)
    return train(training.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "cast(lang as string) lang"))


def trained_identify(docs: DataFrame) -> DataFrame:
    """Train on the folds that aren't held out, label all documents."""
    return identify(docs, train_on_folds(docs))
