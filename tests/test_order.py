"""Row order from files, dense numbering, order statistics and published folders."""

from __future__ import annotations

import json
import random
import statistics
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, scored_row
from vulnsift import queries
from vulnsift.operators import merge
from vulnsift.operators.normalise import normalise_mirror_rows, normalise_primary_pages
from vulnsift.operators.numbering import numbered
from vulnsift.operators.quantiles import order_statistics
from vulnsift.operators.report import credibility_hinges, dimension_summary, median_score, modal_severity
from vulnsift.plans import filter as filter_plan
from vulnsift.plans.filter import filter_summary, read_route, run_filter_pipeline
from vulnsift.plans.ingest import ingest
from vulnsift.queries import q_ingest_files, scored_stage
from vulnsift.schemas import MIRROR_COLUMNS, RECORD_SCHEMA
from vulnsift.session import published_folder, scratch_path
from vulnsift.sources.fixture import pages_of, primary_entries
from vulnsift.sources.landing import read_mirror, read_primary_pages
from vulnsift.sources.stagefiles import read_stage, write_stage


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def mirror(spark, rows):
    """Mirror rows from (ord, id, description)."""
    df = spark.createDataFrame(rows, "ord long, `CVE-ID` string, DESCRIPTION string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in MIRROR_COLUMNS if c not in df.columns]).coalesce(1)


def records_of(mirror_read):
    kept = merge.keep_first(normalise_mirror_rows(mirror_read))
    return [(r["cve_id"], r["description"]) for r in kept.orderBy(*merge.record_order(kept)).collect()]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "csv-multiline"])
@pytest.mark.parametrize("place", [0, 1, 2])
def test_a_placed_row_wins_wherever_it_lies(spark, tmp_path, fmt, place):
    rows = [(5, "A", "placed"), (9, "B", "b")]
    rows.insert(place, (None, "A", "unplaced"))
    df = mirror(spark, rows)
    (df.write.parquet if fmt == "parquet" else df.write.option("header", True).csv)(str(tmp_path / "m"))
    back = read_mirror(spark, str(tmp_path / "m"), fmt)
    assert records_of(back) == [("A", "placed"), ("B", "b")]
    assert "rangepartitioning" not in plan_of(back)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rows_without_positions_follow_the_others_in_file_order(spark, tmp_path, fmt):
    for k, part in enumerate([[(None, "a"), (7, "b")], [(None, "c"), (None, "d"), (3, "e")], [(11, "f"), (None, "g")]]):
        df = mirror(spark, [(o, f"CVE-{x}", x) for o, x in part])
        (df.write.mode("append").parquet if fmt == "parquet" else df.write.mode("append").option("header", True).csv)(str(tmp_path / f"m/p={k}"))
    back = read_mirror(spark, str(tmp_path / "m"), fmt)
    rows = back.orderBy("ord").collect()
    assert [r["DESCRIPTION"] for r in rows] == list("ebfacdg")
    assert [r["ord"] for r in rows][:3] == [3, 7, 11] and len({r["ord"] for r in rows}) == 7


def test_numbers_of_splits_of_one_file(spark, tmp_path):
    lines = [",".join([f"CVE-2020-{i}", "x" * 300, "", "", "", "", ""]) for i in range(3000)]
    (tmp_path / "m.csv").write_text("\n".join([",".join(MIRROR_COLUMNS), *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = read_mirror(spark, str(tmp_path), "csv")
        assert back.rdd.getNumPartitions() > 3
        assert [r[0] for r in back.orderBy("ord").select("CVE-ID").collect()] == [f"CVE-2020-{i}" for i in range(3000)]
        assert back.agg(F.min("ord"), F.max("ord")).first() == (0, 2999)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("per_file", [True, False])
def test_pages_with_and_without_positions(spark, tmp_path, per_file):
    pages = [("a", None, "XB"), ("b", 2, "BC"), ("c", None, "YX"), ("d", 0, "A")]
    texts = [json.dumps({"startIndex": s, "vulnerabilities": [{"cve": {"id": i, "published": name}} for i in ids]}) for name, s, ids in pages]
    if per_file:
        for (name, _, _), t in zip(pages, texts):
            (tmp_path / f"{name}.json").write_text(t)
    else:
        (tmp_path / "all.json").write_text("\n".join(texts))
    read = read_primary_pages(spark, str(tmp_path), per_file)
    assert "rangepartitioning" not in plan_of(read)
    got = merge.keep_first(normalise_primary_pages(read))
    rows = [(r["cve_id"], r["published"]) for r in got.orderBy(*merge.record_order(got)).collect()]
    assert rows == [("A", "d"), ("B", "b"), ("C", "b"), ("X", "a"), ("Y", "c")]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
@pytest.mark.parametrize("ords", [[None, 4, 1, None], [None] * 4, [3, 2, 1, 0]])
def test_stage_files_keep_given_positions(spark, tmp_path, fmt, ords):
    rows = [(o, f"K{i}") for i, o in enumerate(ords)]
    write_stage(spark.createDataFrame(rows, "ord long, cve_id string").coalesce(1), str(tmp_path / "s"), fmt)
    back = read_stage(spark, str(tmp_path / "s"), RECORD_SCHEMA, fmt)
    expected = sorted(range(4), key=lambda i: (ords[i] is None, ords[i] or 0, i))
    assert [r["cve_id"] for r in back.orderBy("ord").collect()] == [f"K{i}" for i in expected]
    assert back.columns == RECORD_SCHEMA.names and "rangepartitioning" not in plan_of(back)


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("text").alias("body")).repartition(7)
    got = {r["k"]: r["n"] for r in numbered(df, [F.col("k").desc()], "n").collect()}
    assert got == {k: 4999 - k for k in range(5000)}
    assert numbered(df.limit(0), [F.col("k")], "n").collect() == []


def test_ingest_numbers_records_densely_and_moves_them_once(spark, tmp_path):
    rows = [(o, f"CVE-{i % 40}", f"d{i}") for i, o in enumerate([None, 3, 8, None, 1] * 30)]
    mirror(spark, rows).write.parquet(str(tmp_path / "m"))
    (tmp_path / "pages").mkdir()
    page = {"startIndex": 0, "vulnerabilities": [{"cve": {"id": i}} for i in ("CVE-7", "P", "", "P")]}
    (tmp_path / "pages" / "p.json").write_text(json.dumps(page))
    run = ingest(spark, str(tmp_path / "pages"), str(tmp_path / "m"), str(tmp_path / "raw"), "parquet")
    got = sorted((r["ord"], r["cve_id"], r["description"]) for r in read_stage(spark, run.output_path, RECORD_SCHEMA).collect())
    seen, expected = set(), []
    landed = [("CVE-7", ""), ("P", "")] + [(c, d) for _, c, d in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, int(r[2][1:])))]
    for c, d in landed:
        if c not in seen:
            seen.add(c)
            expected.append((len(expected), c, d))
    assert got == expected and run.counts["total"] == len(expected)
    wide = spark.createDataFrame([(i, i % 3, None, f"K{i % 5}", "text") for i in range(50)], "_id long, src_rank int, ord long, cve_id string, description string")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(merge.keep_first_renumbered(wide))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    whole = [line for line in plan.split("Initial Plan")[-1].splitlines() if "Exchange" in line]
    assert len(whole) == 4 and "rangepartitioning" not in plan  # the records; narrow: runs, their offsets, ids


def test_pages_are_gathered_and_sorted_in_one_shuffle(spark):
    raw = spark.range(0, 3000, 7).selectExpr("id AS ord", "concat('CVE-', id) AS cve_id", "repeat('text ', 9) AS description", "'2024' AS published", "1.5D AS cvss_score", "'LOW' AS severity", "'CWE-1' AS cwe_id")
    entries = primary_entries(raw.unionByName(raw.where("ord < 200")))
    pages = pages_of(entries, in_order=True)
    rows = pages.collect()
    assert rows == pages_of(entries).orderBy("startIndex").collect() and len(rows) == 36
    whole = [line for line in plan_of(pages).split("Initial Plan")[-1].splitlines() if "Exchange" in line]
    assert len(whole) == 1 and "rangepartitioning" in whole[0]


def test_ingest_files_lands_the_pages_once_and_writes_them_packed(spark, tmp_path, monkeypatch):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'web' AS source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    tags = []
    monkeypatch.setattr(queries, "scratch_path", lambda session, tag: tags.append(tag) or scratch_path(session, tag))
    seen = []
    monkeypatch.setattr(queries, "read_stage", lambda session, path, *rest: seen.append(path) or read_stage(session, path, *rest))
    assert q_ingest_files(spark, str(tmp_path)).count() > 0
    assert sorted(tags) == ["mirror", "mirror", "pages", "raw", "raw"] and len(seen) == 2
    for path in seen:
        for part in Path(path.removeprefix("file:")).glob("part-*.parquet"):
            assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


# order statistics ---------------------------------------------------------------
def spread_values(n, seed):
    rng = random.Random(seed)
    return [rng.choice([rng.random(), rng.expovariate(1) ** 9, -rng.random() * 1e-300, 0.25, float("inf")]) for _ in range(n)]


@pytest.mark.parametrize("n,gather", [(1, 5), (2, 5), (1000, 5), (1000, 5000), (4001, 40)])
def test_order_statistics_equal_a_sort(spark, n, gather):
    values = spread_values(n, n)
    df = spark.createDataFrame([(v, v > 0.5) for v in values], "v double, w boolean")
    columns = {"v": F.col("v"), "half": F.when(F.col("w"), F.lit(1.0)).otherwise(F.lit(0.0))}
    ranks = sorted({1, 2, n // 4 + 1, n // 2, n // 2 + 1, n, n + 1, 0})
    count, at = order_statistics(df, columns, lambda m: {"v": ranks, "half": ranks}, gather=gather, accuracy=20)
    assert count == n
    for name, ordered in (("v", sorted(values)), ("half", sorted(float(v > 0.5) for v in values))):
        assert {r: at[name, r] for r in ranks if 1 <= r <= n} == {r: ordered[r - 1] for r in ranks if 1 <= r <= n}


def test_a_million_different_scores(spark):
    n = 1_000_000
    score = F.col("id") * 104_729 % n / F.lit(float(n))
    df = spark.range(n).select(*[score.alias(c) for c in ("composite_score", "source_credibility_score", "relevance_score", "completeness_score", "clarity_score")])
    assert median_score(df).first()[0] == pytest.approx(0.4999995, abs=1e-6)
    hinges = credibility_hinges(df).first()
    assert (hinges.q1, hinges.q3) == (pytest.approx(0.2499995, abs=1e-6), pytest.approx(0.7499995, abs=1e-6))
    for row in dimension_summary(df).collect():
        assert (row.q1, row["median"], row.q3) == tuple(pytest.approx(p * (n - 1) / n, abs=1e-6) for p in (0.25, 0.5, 0.75))


def test_few_and_no_records(spark, scored):
    assert median_score(scored([])).first()[0] is None and credibility_hinges(scored([scored_row()])).first().q1 is None
    assert [r["median"] for r in dimension_summary(scored([])).collect()] == [None] * 4
    values = [0.125, 0.5, 0.75, 0.25, 1.0]
    df = scored([scored_row(composite_score=v, source_credibility_score=v) for v in values])
    assert median_score(df).first()[0] == statistics.median(values)
    assert credibility_hinges(df).first()["iqr"] == 0.875 - 0.1875


def test_modal_label_with_and_without_positions(scored):
    rows = [scored_row(severity=s, ord=o) for s, o in (("LOW", None), ("LOW", None), ("HIGH", 9), ("HIGH", None), ("MEDIUM", 4))]
    assert modal_severity(scored(rows)).first().top_severity == "HIGH"


# filter run ----------------------------------------------------------------------
def test_summary_has_no_window_over_records_and_equals_the_run(spark, tmp_path):
    df = scored_stage(spark, SF_SMALL)
    summary = filter_summary(df)
    assert "Window" not in plan_of(summary)
    sample = plan_of(filter_plan.sample_of(filter_plan.classify(df)))
    assert sample.count("WindowGroupLimit") >= 2
    assert summary.first().asDict() == run_filter_pipeline(df, str(tmp_path / "out")).summary


def routes(spark, out):
    return {r: sorted(x["cve_id"] for x in read_route(spark, out, r).collect()) for r in (*filter_plan.LARGE_ROUTES, *filter_plan.SAMPLE_ROUTES)}


@pytest.mark.parametrize("failing", [1, 2, 3])
def test_a_failed_run_leaves_the_one_before(spark, scored, tmp_path, monkeypatch, failing):
    out = str(tmp_path / "out")
    first = scored([scored_row(cve_id="A"), scored_row(cve_id="B", composite_score=0.45), scored_row(cve_id="C", clarity_score=0.0)])
    run_filter_pipeline(first, out)
    before, calls = routes(spark, out), []

    def failing_write(*args, **kwargs):
        calls.append(args)
        if len(calls) == failing:
            raise OSError("disk is gone")
        write_stage(*args, **kwargs)

    monkeypatch.setattr(filter_plan, "write_stage", failing_write)
    with pytest.raises(OSError):
        run_filter_pipeline(scored([scored_row(cve_id="Z")]), out)
    assert routes(spark, out) == before and [p.name for p in tmp_path.iterdir()] == ["out"]
    monkeypatch.setattr(filter_plan, "write_stage", write_stage)
    run_filter_pipeline(scored([scored_row(cve_id="Z")]), out)
    assert routes(spark, out) == {"rejected": [], "review": [], "final": ["Z"], "flagged": []} or sum(map(len, routes(spark, out).values())) == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_run_that_died_between_the_renames_is_undone(spark, tmp_path):
    (tmp_path / "out.earlier").mkdir()
    (tmp_path / "out.earlier" / "x").write_text("old")
    with pytest.raises(ValueError):
        with published_folder(spark, str(tmp_path / "out")):
            raise ValueError
    assert (tmp_path / "out" / "x").read_text() == "old" and not (tmp_path / "out.earlier").exists()
