"""Language and quality: held-out accuracy and odd cases."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MEDIUM, SF_SMALL
from pyspark.sql import functions as F

from vulnsift.llm import langid, quality
from vulnsift.llm.pieces import split
from vulnsift.llm.queries import op4_language_id, op8_quality


@pytest.fixture(scope="module")
def model(spark):
    return langid.train_on_folds(spark.read.parquet(f"{SF_MEDIUM}/documents.parquet"))


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet(f"{SF_MEDIUM}/documents.parquet")
    got = op4_language_id(spark, SF_MEDIUM).join(docs, "doc_id")
    held = got.where("held_out").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 100 and held[1] >= 0.99 and 0 <= held[2] <= held[3] <= 1
    assert got.count() == docs.count()


def test_mixed_text_has_spans(model):
    text = "The attention of the others was in this and that with the ing. " * 6 + "Die einung der heiten und das verlich nicht mit den ungen auf. " * 6
    (lang, score, spans), = langid.Labeller(model).label(pa.array([text]))
    assert [s[0] for s in spans] == ["en", "de"] and lang in ("en", "de") and 0.4 < score < 0.7
    begin = text.index("Die")
    assert abs(spans[1][1] - begin) < 30 and spans[0][1] == 0


def best_path(scores, penalty):
    best = scores[0].copy()
    for row in scores[1:]:
        best = np.maximum(best, best.max() - penalty) + row
    return best.max()


def test_viterbi_is_optimal_and_the_shortcut_sound():
    rng = np.random.default_rng(0)
    skipped = 0
    for _ in range(200):
        lengths = rng.integers(1, 40, size=rng.integers(1, 8))
        scores = -rng.exponential(2, size=(lengths.sum(), 3))
        ends = np.cumsum(lengths)
        for a, b, path in zip(ends - lengths, ends, langid.viterbi(scores, ends - lengths, ends, 4.0)):
            own = scores[a:b]
            value = own[np.arange(b - a), path].sum() - 4.0 * (np.diff(path) != 0).sum()
            assert value == pytest.approx(best_path(own, 4.0))
            running = np.concatenate([np.zeros((1, 3)), np.cumsum(own, 0)])
            top = running[-1].argmax()
            if langid.one_language_suffices(running - running[:, top, None], 4.0):
                skipped += 1
                assert own[:, top].sum() == pytest.approx(best_path(own, 4.0))
    assert skipped > 20


def test_scripts_narrow_candidates(spark):
    rows = [(i, "привет мир как дела у вас сегодня", "ru") for i in range(20)] + [(i, "hello world how are you today", "en") for i in range(20, 40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.scripts == {"latin": [0], "cyrillic": [1]}
    found = [x[0] for x in langid.Labeller(model).label(pa.array(["мир", "abc мир привет вам всем", "日本語", "qqqq"]))]
    assert found[:2] == ["ru", "ru"] and found[2] in ("en", "ru") and found[3] == "en"
    assert [langid.script(c) for c in "aЖ日가ñ"] == ["latin", "cyrillic", "han", "hangul", "latin"]


def test_odd_documents_language(odd_docs, no_docs, model):
    got = langid.identify(odd_docs, model)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == odd_docs.count()
    letterless = {0, 1, 2, 3, 11}
    for doc, lang, score, spans in rows:
        assert (lang == "und") == (doc in letterless or doc is None and not spans), (doc, lang)
        assert 0 <= score <= 1
        if lang == "und":
            assert score == 0 and spans == []
    assert langid.identify(no_docs, model).count() == 0
    untrained = langid.train_on_folds(no_docs)
    assert {r[0] for r in langid.identify(odd_docs, untrained).select("lang_pred").collect()} == {"und"}
    kept = langid.keep_identified(odd_docs, model, 0.35)
    assert kept.columns == odd_docs.columns and 0 < kept.count() < odd_docs.count()


def test_quality_accuracy_on_held_out(spark):
    labels = spark.read.parquet(f"{SF_MEDIUM}/labels.parquet")
    got = op8_quality(spark, SF_MEDIUM)
    held = got.where("held_out").join(labels, "doc_id").agg(F.count("*"), F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert held[0] > 50 and held[1] >= 0.95
    assert got.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_odd_documents_quality(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1), (9, 0), (12, 1), (None, 1), (7, None), (6, 1), (4, 7)], "doc_id long, quality int")
    got = quality.trained_classify(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.where("score is null").count() == 0
    assert quality.trained_classify(no_docs, labels).count() == 0
    none = labels.where("false")
    assert {r[0] for r in quality.trained_classify(odd_docs, none).select("score").collect()} == {0.5}
    model = quality.train_on_folds(odd_docs, none)
    assert quality.keep_predicted(odd_docs, model).columns == odd_docs.columns


M64 = (1 << 64) - 1


def scrambled(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & M64
    return x ^ (x >> 31)


def naive_score(text, model, hash_of):
    """The score of a text, feature by feature."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    values = []
    for w in words:
        signs = "\x02" + w + "\x03"
        for n in quality.SIZES:
            for i in range(len(signs) - n + 1):
                rolling = 0
                for k, c in enumerate(signs[i : i + n], 1):
                    rolling = (rolling * 0x100000001B3 + ord(c) + k) & M64
                values.append(float(model.weights[scrambled(rolling) % quality.BUCKETS, 0]))
        h = hash_of[w]
        values.append(float(model.words[(h ^ (h >> 31)) % quality.WORDS]))
    for a, b in zip(words, words[1:]):
        j = hash_of[a] ^ hash_of[b]
        values.append(float(model.pairs[(j ^ (j >> 29)) % quality.PAIRS]))
    return 1 / (1 + math.exp(-(sum(values) / max(1, len(values)) + model.bias)))


def test_scores_equal_a_plain_sum_over_features(spark, odd_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    model = quality.train_on_folds(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    docs = docs.where("length(text) < 3000").unionAll(odd_docs.where("length(text) < 5000").selectExpr("doc_id + 100000", "text"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    words = sorted({w for t in rows.values() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")})
    hash_of = dict(zip(words, split(pa.array([" ".join(words)])).hashes.tolist()))
    got = quality.classify(docs, model).collect()
    assert len(got) == docs.count() > 100
    wrong = [r.doc_id for r in got if abs(r.score - naive_score(rows[r.doc_id], model, hash_of)) > 1e-6]
    assert wrong == []


def test_a_whole_word_has_a_vector():
    one, other = quality.features(pa.array(["é日本語x", "é日本語x y"]))
    start = quality.BUCKETS + quality.PAIRS
    assert sum(x >= start for x in one[0]) == 1 and sum(x >= start for x in other[0]) == 2
    # Characters, not bytes: 7 signs with the marks give 6, 5 and 4 n-grams.
    assert one[1][one[0] < quality.BUCKETS].sum() == 6 + 5 + 4


def test_repeated_words_share_a_feature():
    (at, times), (other, _) = quality.features(pa.array(["aa aa aa", "bb bb"]))
    shared = set(at.tolist()) & set(other.tolist())
    assert any(x >= quality.BUCKETS for x in shared) and times.sum() > len(at) - 1


def test_a_script_keeps_its_languages(spark):
    rows = [(i, "привет мир как дела у вас сегодня", "ru") for i in range(20)] + [(i, "hello world how are you today", "en") for i in range(20, 40)]
    labeller = langid.Labeller(langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    english = "hello world how are you today " * 3
    inner, last, latin = labeller.label(pa.array([english + "привет мир " + english, english + "мир", "привет мир как дела hello у вас сегодня"]))
    assert inner[0] == last[0] == "en" and latin[0] == "ru"
    assert [[s[0] for s in x[2]] for x in (inner, last, latin)] == [["en", "ru", "en"], ["en", "ru"], ["ru", "en", "ru"]]
    assert inner[2][1][1:] == (len(english), len(english) + len("привет мир".encode()))
