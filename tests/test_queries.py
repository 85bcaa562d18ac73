"""Registered queries: SQL-oracle agreement, order independence and plan shape."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from vulnsift import oracle, queries

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES = queries.queries()
ORACLES = oracle.oracles()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 36
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for col, dtype in df.dtypes:
        assert SPARK_TO_DUCK.get(dtype, dtype) == duck_types[col], (col, dtype, duck_types[col])
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(rel.columns, rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["merge_dedup", "stratified_sample", "credibility_iqr", "modal_severity",
                                  "top20_table", "filter_summary", "ingest_records", "callout_facts"])
def test_results_do_not_depend_on_partitioning(spark, name):
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = QUERIES[name](spark, SF_SMALL)
            results.append(_rows(df.columns, [tuple(r) for r in df.collect()]))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def test_filter_invariants(spark):
    s = QUERIES["filter_summary"](spark, "/root/testdata/sf0.01").first().asDict()
    assert s["total_input"] == s["hard_excluded"] + s["training_ready_raw"] + s["review_queue"] + s["tier_rejected"]
    assert s["sampled"] == s["training_final"] + s["flagged_contamination"]
    assert s["sampled"] <= 5 * 50


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    """The executed plan with its subqueries, without the initial plan."""
    mode = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    initial = {int(n) for part in re.findall(r"== Initial Plan ==\n(.*?)\n\n", text, re.S) for n in re.findall(r"\((\d+)\)$", part, re.M)}
    final = {int(n) for part in re.findall(r"== Final Plan ==\n(.*?)== Initial Plan ==", text, re.S) for n in re.findall(r"\((\d+)\)$", part, re.M)}
    return re.sub(r"^\((\d+)\) Scan", lambda m: m[0] if int(m[1]) not in initial - final else "initial scan", text, flags=re.M)


def test_no_python_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert marker not in plan, (name, marker)


def test_plan_shapes(spark):
    sample = _plan(QUERIES["stratified_sample"](spark, SF_SMALL))
    assert sample.count("WindowGroupLimit") >= 2 and "Join" not in sample
    assert "TakeOrderedAndProject" in _plan(QUERIES["top20_stats"](spark, SF_SMALL))
    dedup = _plan(QUERIES["merge_dedup"](spark, SF_SMALL))
    assert "WindowGroupLimit" in dedup and "Join" not in dedup
    assert "SinglePartition" not in _plan(QUERIES["nvd_normalise"](spark, SF_SMALL))


@pytest.mark.parametrize("name,scans", [("stratified_sample", 1), ("training_final", 1), ("filter_summary", 1), ("callout_facts", 2),
                                        ("nvd_normalise", 1), ("hf_normalise", 2), ("modal_severity", 1)])
def test_scans_of_the_executed_plan(spark, name, scans):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    assert len(re.findall(r"^\(\d+\) Scan parquet", _formatted(df), re.M)) == scans


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ord", "cve_id", "severity", "published", "composite_score", "severity_rank", "sample_rank"]


@pytest.fixture(scope="module")
def shuffled_dir(spark, tmp_path_factory):
    """The sf0.001 documents in a random row order, spread over five files."""
    from pyspark.sql import functions as F

    out = tmp_path_factory.mktemp("shuffled")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.orderBy(F.rand(7)).repartition(5).write.parquet(str(out / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").orderBy(F.rand(7)).repartition(3).write.parquet(str(out / "orders.parquet"))
    return str(out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_results_do_not_depend_on_input_order(spark, shuffled_dir, name):
    base = QUERIES[name](spark, SF_SMALL)
    moved = QUERIES[name](spark, shuffled_dir)
    assert _rows(base.columns, [tuple(r) for r in base.collect()]) == _rows(moved.columns, [tuple(r) for r in moved.collect()])
