"""Merkle manifest against trees built row by row."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vulnsift.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def climb(nodes):
    """The root of ``nodes`` and for each of them its siblings with their sides."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            other = p ^ 1
            paths[i].append((nodes[other], other < p) if other < len(nodes) else None)
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], paths


def fold(node, path):
    for step in path:
        node = H(node) if step is None else H(step[0] + node if step[1] else node + step[0])
    return node


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, uppers = climb([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, upper in zip(names, uppers):
        for (_, _, leaf, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            claimed = leaf_of({**r, "n_chars": r["n_chars"] + 1}) if r["bad"] and r["n_chars"] is not None else leaf
            proof = "".join(s[0] for s in path + upper if s)
            folded = fold(claimed, path + upper)
            out.append((r["doc_id"], leaf, trees[g][0], root, H(proof), folded, folded == root))
    return sorted(out, key=str)


def by_operator(docs):
    more = [(F.col("n_chars") + 1).alias("n_chars") if f == "n_chars" else F.col(f) for f in FIELDS]
    manifest = merkle.build_manifest(docs, FIELDS, "lang", "doc_id", F.when(F.col("bad"), merkle.row_hash(more)))
    rows = merkle.verify_rows(manifest).collect()
    return sorted(((r.key, r.leaf.hex(), r.subroot.hex(), r.root.hex(), H(r.proof.hex()), r.folded.hex(), r.verified) for r in rows), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, bad boolean, tree string, step int, hash string").repartition(3)


def rows_of(n, groups, seed=1):
    rng = random.Random(seed)
    return [
        (rng.randrange(10 * n), rng.choice([None, "s", "zß"]), rng.choice(groups), rng.choice([None, 5, 2**40]), rng.choice([None, "", "a:1-", "é日本 text"]), rng.random() < 0.2, "x", 1, "y")
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "rows",
    [
        rows_of(1, ["en"]),
        rows_of(2, ["en"]) + rows_of(513, [None]) + rows_of(1, ["z"]),
        rows_of(300, ["en", "é", None]) + [(None, None, None, None, None, True, None, None, None)] * 3 + [(7, "s", "en", 1, "same", False, "x", 1, "y")] * 70,
        rows_of(1300, [f"g{i}" for i in range(600)]) + rows_of(1500, ["big"], 3),
    ],
    ids=["one row", "lone leaves", "nulls and repeated rows", "many groups"],
)
def test_equal_to_trees_built_row_by_row(spark, rows):
    docs = table(spark, rows)
    assert by_operator(docs) == plain([r.asDict() for r in docs.collect()])


def test_upper_nodes_stand_once_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 3)
    n = 8**4 + 700  # five strides of three levels
    docs = spark.range(n).select(
        (F.col("id") * 3).alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < n - 5, "en").otherwise("fr").alias("lang"),
        F.col("id").alias("n_chars"), F.col("id").cast("string").alias("text"), (F.col("id") % 11 == 0).alias("bad"),
    )
    found, expected = by_operator(docs), plain([r.asDict() for r in docs.collect()])
    assert len(found) == n and [x for x, y in zip(found, expected) if x != y][:2] == []
    nodes = merkle.build_manifest(docs, FIELDS, "lang", "doc_id").nodes
    passed = nodes.groupBy("tree", "step", "block").count().agg(F.max("count")).first()[0]
    assert passed == 1 and nodes.where("step = 4").count() == -(-(n - 5) // 8)


def test_order_of_the_input_and_empty_table(spark):
    docs = table(spark, rows_of(100, ["a", "b"], 7))
    one, other = (merkle.verify_rows(merkle.build_manifest(d, FIELDS, "lang", "doc_id")) for d in (docs, docs.orderBy("text", "doc_id")))
    assert one.select("root").distinct().collect() == other.select("root").distinct().collect()
    assert merkle.verify_rows(merkle.build_manifest(docs.limit(0), FIELDS, "lang", "doc_id")).collect() == []
    assert docs.sparkSession.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"
