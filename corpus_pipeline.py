"""Corpus pipeline: language ID, quality, near duplicates, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnsift.llm import jaccard, langid, packing, quality
from vulnsift.llm.common import stored, table
from vulnsift.llm.queries import WORD_BPE

# A text of one language scores at least 0.5 however short it is; below this, it
# is a mixture in which no language has much of a share.
LEAST_LANGUAGE_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, null texts among them, and
    mixtures without a main language go."""
    return langid.keep_identified(docs, langid.train_on_folds(docs), LEAST_LANGUAGE_SCORE)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    return quality.keep_predicted(docs, quality.train_on_folds(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row: that of the least id, rows without an id
    after all others, and of several such rows the one of the least hash of all its
    columns; rows are told apart by a number of their own, so one id may have several texts.
    Of the rows without words one stays for each id, and all that have no id."""
    mark = uuid.uuid4().hex  # no column of the table has these names
    row, content, none = f"row_{mark}", f"content_{mark}", F.col("doc_id").isNull()
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    # Written, so that a task that runs again gives a row the number it had; these are whole
    # texts, and Zstandard takes three quarters of what Snappy does.
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(content, every), "keyed", "zstd")
    classes = jaccard.near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias(row), (F.col("n_shingles") > 0).alias("words"), "component_id")
    known = keyed.select(row, "doc_id", content).join(classes, row)
    of = F.when(F.col("words"), F.struct(F.col("component_id").alias("c"), F.lit(None).cast(keyed.schema["doc_id"].dataType).alias("d")))
    alone = F.struct(F.when(none, F.col(row)).alias("c"), F.col("doc_id").alias("d"))
    first = known.groupBy("words", F.coalesce(of, alone).alias("class")).agg(F.min(F.struct(none.alias("late"), "doc_id", content, row)).alias("first"))
    return keyed.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack what is left into sequences of 2048 tokens."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [("language", language), ("quality", clean), ("near_duplicates", deduplicate), ("packing", pack)]
ORACLE_SQL = None  # trained classifiers and a tokenizer file have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what its predecessor kept, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
