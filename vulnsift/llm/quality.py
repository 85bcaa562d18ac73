"""Quality classifier with learned subword vectors (operator 8)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.common import bounded_batches, crc_mod, held, map_batches
from vulnsift.llm.ngrams import collected, gram_sums, grams, sample_rows
from vulnsift.llm.pieces import Ragged, WordTable, split

SIZES = (2, 3, 4)
BUCKETS = 1 << 16
PAIRS = 1 << 14  # of word pairs, after the others
WORDS = 1 << 15  # of whole words, after those
DIM = 8


@dataclass(eq=False)
class QualityModel:
    """With a linear output, a feature's vector acts by its projection on the
    difference of the two classes: ``weights`` holds that for every bucket of
    character n-grams inside words, ``pairs`` for those of word pairs, ``words`` for those of
    whole words."""

    weights: np.ndarray
    pairs: np.ndarray
    words: np.ndarray
    bias: float


def _pair_buckets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word with the next one in its text, and the text's number.
    The hashes join by exclusive or: any word repeated at once shares a bucket."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = owner[1:] == owner[:-1]
    joined = (hashes[1:] ^ hashes[:-1])[same]
    return ((joined ^ (joined >> np.uint64(29))) & np.uint64(PAIRS - 1)).astype(np.int64), owner[1:][same]


def _word_buckets(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(31))) & np.uint64(WORDS - 1)).astype(np.int64)


def features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct buckets of its words, their character n-grams and word pairs, and
    how often each occurs."""
    p = split(texts)
    _, first, codes = np.unique(p.hashes, return_index=True, return_inverse=True)
    words = [p.buf[s:e].tobytes() for s, e in zip(p.starts[first].tolist(), p.ends[first].tolist())]
    ragged = Ragged(np.int32)
    if words:
        found = [(owner[inside], bucket[inside]) for bucket, inside, owner in grams(words, SIZES, BUCKETS, characters=True)]
        owner, bucket = np.concatenate([o for o, _ in found]), np.concatenate([b for _, b in found])
        order = np.argsort(owner, kind="stable")
        ragged.extend(bucket[order], np.bincount(owner, minlength=len(words)))
    pairs, of = _pair_buckets(p.hashes, p.offsets)
    cuts = np.searchsorted(of, np.arange(len(p.offsets)))
    out = []
    for i in range(len(p.offsets) - 1):
        own = ragged.take(codes[p.offsets[i] : p.offsets[i + 1]])[0] if len(words) else np.zeros(0, np.int32)
        single = _word_buckets(p.hashes[p.offsets[i] : p.offsets[i + 1]]) + BUCKETS + PAIRS
        every = np.concatenate([own, pairs[cuts[i] : cuts[i + 1]] + BUCKETS, single])
        out.append(tuple(x.astype(np.int32) for x in np.unique(every, return_counts=True)))
    return out


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, epochs: int = 8, rate: float = 0.6, seed: int = 11) -> QualityModel:
    """Stochastic gradient descent on the softmax loss of averaged feature vectors.
    ``prior`` corrects the bias for a sample that isn't in proportion."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + PAIRS + WORDS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    out[:, 1] = rng.uniform(-0.5, 0.5, DIM)
    out[:, 0] = -out[:, 1]
    steps, total = 0, max(1, epochs * len(labels))
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            at, times = examples[i]
            step = rate * (1 - steps / total)
            steps += 1
            if not len(at):
                continue
            share = (times / times.sum()).astype(np.float32)
            mean = share @ vectors[at]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= step * np.outer(mean, p)
            bias -= step * p
            # Each feature moves by its share; the scale makes steps of a long text count.
            vectors[at] -= (step * 25) * share[:, None] * back
    apart = out[:, 1] - out[:, 0]
    projected = vectors @ apart
    weights, pairs, words = np.split(projected.astype(np.float32), [BUCKETS, BUCKETS + PAIRS])
    return QualityModel(weights[:, None], pairs, words, float(bias[1] - bias[0]) + prior)


def train(docs: DataFrame, marked: DataFrame, per_label: int = 2000, longest: int = 20_000) -> QualityModel:
    """Fit on about ``per_label`` documents of each label, of at most ``longest``
    characters (``docs``: doc_id, text; ``marked``: doc_id, quality). Without both
    labels the score leans to the one there is (0.5 without any)."""
    chosen, counts = sample_rows(marked, "quality", per_label)
    # The sample is bounded, so it goes to the documents.
    rows = docs.where("text is not null").join(F.broadcast(chosen), "doc_id")
    sample = collected(rows, "quality", per_label, longest)
    labels = np.array([int(q) for _, q in sample], np.int64)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    s1 = int(labels.sum())
    s0 = len(labels) - s1
    if not s0 or not s1:
        return QualityModel(*[np.zeros(n, np.float32) for n in ((BUCKETS, 1), PAIRS, WORDS)], 0.0 if n0 == n1 else (8.0 if n1 > n0 else -8.0))
    examples = []
    for i in range(0, len(sample), 200):
        examples += features(pa.array([t for t, _ in sample[i : i + 200]], pa.string()))
    return fit(examples, labels, float(np.log((n1 / n0) / (s1 / s0))))


class Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.table = WordTable(self._learn, self._forget)

    def _forget(self) -> None:
        self.sums, self.counts = np.zeros(0), np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        sums, counts = gram_sums(words, SIZES, self.model.weights, characters=True)
        self.sums, self.counts = np.concatenate([self.sums, sums[:, 0]]), np.concatenate([self.counts, counts])

    def score(self, texts: pa.Array) -> np.ndarray:
        p = split(texts)
        rows = self.table.rows_of(p)
        n = len(p.offsets) - 1
        owner = np.repeat(np.arange(n), np.diff(p.offsets))
        pairs, of = _pair_buckets(p.hashes, p.offsets)
        total = np.bincount(owner, self.sums[rows] + self.model.words[_word_buckets(p.hashes)], n) + np.bincount(of, self.model.pairs[pairs], n)
        count = np.bincount(owner, self.counts[rows] + 1, n) + np.bincount(of, minlength=n)
        logit = total / np.maximum(count, 1) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _held(shared) -> Scorer:
    """The worker's scorer for a broadcast model."""
    return held("quality", shared.value, lambda: Scorer(shared.value))


def classify(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text): doc_id, score, predicted.

    Score: probability of label 1; ``predicted`` is 1 from 0.5 on. Null, empty and
    blank texts have no features and get the model's bias. Repeated rows and null
    ids are scored like any other; an empty table gives no rows; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_batches(batches, "text"):
            score = _held(shared).score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, "doc_id long, score double, predicted int")


def keep_predicted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` predicted as label 1; all columns as they are. Cases as
    in ``classify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_batches(batches, "text"):
            yield batch.filter(pa.array(_held(shared).score(batch.column("text")) >= 0.5))

    return map_batches(docs, run, docs.schema)


def train_on_folds(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on the labels whose crc32(doc_id) modulo 3 isn't 1. A document with
    several labels trains with each."""
    marked = labels.where("quality in (0, 1)").selectExpr("cast(doc_id as long) doc_id", "cast(quality as int) quality").where("doc_id is not null")
    own = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return train(own, marked.where(crc_mod(F.col("doc_id"), 3) != 1))


def trained_classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the folds that aren't held out, score all documents."""
    return classify(docs, train_on_folds(docs, labels))
