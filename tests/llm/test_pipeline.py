"""The pipeline, the registered queries and their SQL."""

from __future__ import annotations

import os
import time

import duckdb
import pyarrow.parquet as pq
import pytest
from conftest import SF_MEDIUM, SF_SMALL

import __spark_entry__ as entry
import corpus_pipeline
from vulnsift.llm import jaccard, langid, packing, quality
from vulnsift.llm.common import FREE_SHUFFLES, stored
from vulnsift.llm.queries import WORD_BPE
from vulnsift.session import ensure_checkpoint_dir

from llm.test_jaccard import brute


def test_every_query_is_registered():
    own = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in own) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", ["op1_threshold_topk", "op6_license_scan", "op11_merkle_manifest", "op13_chat_format"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MEDIUM}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_MEDIUM)
    want = con.sql(entry.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_stages_one_by_one(spark):
    """Each stage against a plain recomputation from its own input."""
    docs = spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF_MEDIUM}/labels.parquet")
    named = corpus_pipeline.language(spark, docs, SF_MEDIUM)
    scores = langid.identify(docs, langid.train_on_folds(docs)).where("lang_pred <> 'und'").where(f"score >= {corpus_pipeline.LEAST_LANGUAGE_SCORE}")
    assert {r[0] for r in named.select("doc_id").collect()} == {r[0] for r in scores.select("doc_id").collect()}
    assert named.columns == docs.columns and named.count() >= 0.99 * docs.count()

    good = corpus_pipeline.clean(spark, named, SF_MEDIUM)
    marks = quality.classify(named, quality.train_on_folds(named, labels)).where("predicted = 1")
    assert {r[0] for r in good.select("doc_id").collect()} == {r[0] for r in marks.select("doc_id").collect()}
    wrong = good.join(labels, "doc_id").where("quality = 0").count() + named.join(labels, "doc_id").where("quality = 1").join(good, "doc_id", "left_anti").count()
    assert good.columns == docs.columns and wrong <= 0.02 * labels.count()

    single = corpus_pipeline.deduplicate(spark, good, SF_MEDIUM)
    want = brute([tuple(r) for r in good.select("doc_id", "text").collect()])
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted(d for d, _, c in want if d == c)
    assert single.columns == docs.columns

    packed = corpus_pipeline.pack(spark, single, SF_MEDIUM)
    again = packing.pack_documents(single, WORD_BPE)
    assert packed.agg({"length": "sum"}).first() == again.agg({"length": "sum"}).first()
    docs.unpersist()


def test_run_and_odd_documents(spark, odd_docs, no_docs, tmp_path):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(6, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).columns == packing.COLUMNS
    kept = corpus_pipeline.deduplicate(spark, odd_docs, "")
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and ids.count(None) == 1
    assert jaccard.near_duplicates(odd_docs).count() == odd_docs.count()


def test_rows_of_one_id(spark):
    """Rows, not ids, are kept: an id with several texts, copies without an id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a, "x"), (5, a + " more", "x"), (5, b, "x"), (5, b, "x"), (6, "", "x"), (6, None, "x"), (7, a, "x"), (8, c, "z"), (8, c, "y"), (9, c, "a")]
    rows += [(None, c + f" {i % 2}", "n") for i in range(5)] + [(None, "", "n"), (None, None, "n")]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        kept = [tuple(r) for r in corpus_pipeline.deduplicate(spark, docs, "").collect()]
        assert sorted((d, t) for d, t, _ in kept if d is not None and t) == [(3, a), (5, b), (8, c)]
        assert [d for d, t, _ in kept if d is not None and not t] == [6]
        without = [t for d, t, _ in kept if d is None]
        # Rows without an id are held against all: these are near copies of document 8.
        assert len(without) == 2 and not any(without)


def test_rows_without_an_id_and_clashing_columns(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(None, a, 1, "k"), (4, a + " more", 2, "k"), (None, b, 3, "k"), (None, b, 4, "k"), (None, b + " end", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long, __content string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.deduplicate(spark, docs, "").collect()]
    assert len(kept) == 2 and (4, a + " more", 2, "k") in kept and set(kept) <= set(rows)


def files_of(spark, kind):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in found.mkString("\n").splitlines() if os.path.basename(x).startswith(kind)}


def test_near_duplicates_hold_little_disk(spark):
    """What an intermediate table shuffled goes once it is stored, texts are stored with
    Zstandard, and shingles as six bytes, the prefix not twice."""
    rows = [(i, " ".join(f"w{(i // 3) * 60 + k}" for k in range(60)) + " end" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    checkpoints = ensure_checkpoint_dir(spark).removeprefix("file:")
    shuffled, folders, setting = files_of(spark, "shuffle_"), set(os.listdir(checkpoints)), spark.conf.get(FREE_SHUFFLES, None)
    kept = corpus_pipeline.deduplicate(spark, docs, "")
    for _ in range(40):  # executors delete them a little later
        if left := files_of(spark, "shuffle_") - shuffled:
            time.sleep(0.25)
    assert not left and spark.conf.get(FREE_SHUFFLES, None) == setting
    new = {tag: f"{checkpoints}/{x}" for x in set(os.listdir(checkpoints)) - folders for tag in ("keyed", "sets", "nodes") if x.startswith(f"llm-{tag}-")}
    parts = [os.path.join(new["keyed"], x) for x in os.listdir(new["keyed"]) if x.endswith(".parquet")]
    assert {pq.ParquetFile(x).metadata.row_group(0).column(1).compression for x in parts} == {"ZSTD"}
    for tag in ("sets", "nodes"):
        found = spark.read.parquet(new[tag])
        assert "prefix" not in found.columns
        assert found.where("tokens is not null").count() > 0 and found.where("octet_length(tokens) <> 6 * shared").isEmpty()
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == list(range(0, 300, 3))


def test_stored_gives_the_setting_back(spark):
    for value in (None, "true", "false"):
        if value is not None:
            spark.conf.set(FREE_SHUFFLES, value)
        try:
            assert stored(spark.range(5).groupBy().count(), "counted").first()[0] == 5
            with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
                stored(spark.sql("select 1 div (id - id) x from range(3)"), "fails")
            assert spark.conf.get(FREE_SHUFFLES, None) == value
        finally:
            spark.conf.unset(FREE_SHUFFLES)
