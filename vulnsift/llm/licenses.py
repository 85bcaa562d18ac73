"""License scan: TF-IDF cosine to templates, then inheritance by directory (operator 6).

DataFrame operations only.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.llm.common import stored

# Notices by which works name their license (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("ISC", "Released under the ISC License"),
    ("Unlicense", "Released into the public domain under the Unlicense"),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
]
# Headers of source files, longer than a line.
_GNU = "{it} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation; {version} of the License, or (at your option) any later version."
NOTICES = [
    ("GPL-2.0", _GNU.format(it="This program", name="", version="either version 2")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", _GNU.format(it="This program", name="", version="either version 3")),
    ("LGPL-2.0", _GNU.format(it="This library", name="Library ", version="either version 2")),
    ("LGPL-2.1", _GNU.format(it="This library", name="Lesser ", version="either version 2.1")),
    ("LGPL-3.0", _GNU.format(it="This library", name="Lesser ", version="either version 3")),
    ("AGPL-3.0", _GNU.format(it="This program", name="Affero ", version="either version 3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
]
# Licenses short enough to stand in a header as a whole, from these words on.
SHORT = {"MIT": "Permission is", "ISC": "Permission to", "BSD-2-Clause": "Redistribution and", "BSD-3-Clause": "Redistribution and", "Unlicense": "This is free"}
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
TEXT_THRESHOLD = 0.85  # for whole texts and long headers, much of which is common to all licenses
MARKER = "licen[cs]|copyright|spdx"
EDGE = "[.,;:]+( |$)"
GAP = "[^a-z0-9.+-]+"
THRESHOLD = 0.6


@lru_cache
def license_texts() -> list[tuple[str, str]]:
    """The full-text templates: the files of ``license_texts``, named by license."""
    out = []
    for name in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, name), encoding="utf-8") as f:
            out.append((name.removesuffix(".txt"), f.read()))
    return out


def long_notices() -> list[tuple[str, str]]:
    """Headers that go over several lines: NOTICES and the licenses of SHORT."""
    return NOTICES + [(name, text[text.index(SHORT[name]) :]) for name, text in license_texts() if name in SHORT]


def _tokens(text: str) -> list[str]:
    import re

    return [t for t in re.split(GAP, re.sub(EDGE, " ", text.lower())) if t]


def template_weights(templates: list[tuple[str, str]]) -> tuple[dict[str, float], dict[tuple[int, str], float], float]:
    """idf by token; the unit TF-IDF vectors of the templates; the idf of any other token."""
    counts = [Counter(_tokens(text)) for _, text in templates]
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in df.items()}
    weights = {}
    for k, c in enumerate(counts):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        weights |= {(k, t): n * idf[t] / norm for t, n in c.items()}
    return idf, weights, math.log(1 + len(templates)) + 1


def header_tokens(line: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(line), EDGE, " "), GAP), lambda t: t != "")


def match_headers(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """For files (path, text) with a notice: path, license, score of the best line. A null or
    empty text has no line; files of one path count together.

    A line with a marker word is a header. Its TF-IDF vector meets each template
    through the tokens they share; the norm takes all of its tokens.
    """
    templates = templates or TEMPLATES
    spark = files.sparkSession
    idf, weights, other = template_weights(templates)
    n = len(templates)
    # One row for each token of the templates: a fixed list, so its broadcast is bounded.
    table = spark.createDataFrame([(t, v, [weights.get((k, t), 0.0) for k in range(n)]) for t, v in idf.items()], "token string, idf double, w array<double>").coalesce(1)
    lines = files.where(F.lower("text").rlike(MARKER)).select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.lower("line").rlike(MARKER))
    tokens = lines.select("path", "pos", header_tokens(F.col("line")).alias("all"))
    each = tokens.select("path", "pos", "all", F.explode(F.array_distinct("all")).alias("token"))
    each = each.withColumn("tf", F.size(F.filter("all", lambda t: t == F.col("token")))).drop("all")
    weighed = each.join(F.broadcast(table), "token", "left").withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(other)))
    products = [F.coalesce(F.sum(F.col("v") * F.element_at("w", k + 1)), F.lit(0.0)).alias(f"s{k}") for k in range(n)]
    scored = weighed.groupBy("path", "pos").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), *products)
    options = F.array(*[F.struct(F.round(F.col(f"s{k}") / F.col("norm"), 6).alias("score"), F.lit(-k).alias("first"), F.lit(name).alias("license")) for k, (name, _) in enumerate(templates)])
    best = scored.select("path", F.array_max(options).alias("best")).groupBy("path").agg(F.max("best").alias("best"))
    return best.where(F.col("best.score") >= threshold).select("path", F.col("best.license").alias("license"), F.col("best.score").alias("score"))


STRETCH = 6  # positions of a text that runs and tokens meet in: 2 to this power
EDGES = r"[.,;:]+(\s|$)"  # EDGE, whatever the white space


def text_tokens(text: Column) -> Column:
    """The tokens of a text across its lines, without the bare signs of comments."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), EDGES, " "), GAP), lambda t: t.rlike("[a-z0-9]"))


def _plain(templates: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    import re

    return [(name, [t for t in re.split(GAP, re.sub(EDGES, " ", text.lower())) if re.search("[a-z0-9]", t)]) for name, text in templates]


def _table(spark, templates: list[tuple[str, list[str]]]) -> tuple[DataFrame, float]:
    """The tokens of the templates with idf and unit weights; the idf of others."""
    idf, weights, other = template_weights([(name, " ".join(tokens)) for name, tokens in templates])
    n = range(len(templates))
    rows = [(t, v, [weights.get((k, t), 0.0) for k in n]) for t, v in idf.items()]
    return spark.createDataFrame(rows, "token string, idf double, w array<double>").coalesce(1), other


def _marked(files: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """path, key, tokens of the texts with a marker word; the key tells texts of one path
    apart. ``within`` holds the (path, key) wanted. Texts are shuffled, not their tokens."""
    texts = files.where(F.lower("text").rlike(MARKER)).select("path", F.xxhash64("text").alias("key"), "text")
    if within is not None:
        texts = texts.join(within, ["path", "key"], "left_semi")
    return texts.dropDuplicates(["path", "key"]).select("path", "key", text_tokens(F.col("text")).alias("tokens"))


def match_texts(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = TEXT_THRESHOLD) -> DataFrame:
    """For licence files (path, text) that are a license as a whole: path, license,
    score, first. The TF-IDF vector of the whole text meets each full text. Null and empty
    texts meet none; repeated texts of a path give one row."""
    templates = _plain(license_texts() if templates is None else templates)
    table, other = _table(files.sparkSession, templates)
    counts = _marked(files).select("path", "key", F.explode("tokens").alias("token")).groupBy("path", "key", "token").agg(F.count("*").alias("tf"))
    weighed = counts.join(F.broadcast(table), "token", "left").withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(other)))
    products = [F.coalesce(F.sum(F.col("v") * F.element_at("w", k + 1)), F.lit(0.0)).alias(f"s{k}") for k in range(len(templates))]
    scored = weighed.groupBy("path", "key").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), *products)
    options = F.array(*[F.struct(F.round(F.col(f"s{k}") / F.col("norm"), 6).alias("score"), F.lit(-k).alias("first"), F.lit(name).alias("license")) for k, (name, _) in enumerate(templates)])
    return scored.select("path", F.array_max(options).alias("best")).where(F.col("best.score") >= threshold).select("path", "best.license", "best.score", "best.first")


def match_windows(files: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """For files (path, text) with a notice anywhere: path, license, score, first.

    Every run of tokens as long as a template meets it, across line breaks and
    inside long lines (a shorter text meets it as a whole). A run must hold a
    marker word. Null and empty texts have no run; repeated texts of a path count once. Running sums give for each run the products and a norm that takes
    repeated tokens for different ones, so at most the true norm; only runs that
    reach the threshold with that are counted out.
    """
    templates = _plain(templates)
    table, other = _table(files.sparkSession, templates)
    sizes = [len(tokens) for _, tokens in templates]
    texts = _marked(files)
    each = texts.select("path", "key", F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "token")).join(F.broadcast(table), "token", "left")
    idf = F.coalesce("idf", F.lit(other))
    up_to = Window.partitionBy("path", "key").orderBy("pos")
    running = {"q": idf * idf, "m": F.col("token").rlike(MARKER).cast("int")}
    running |= {f"s{k}": F.coalesce(F.col("idf") * F.element_at("w", k + 1), F.lit(0.0)) for k in range(len(templates))}
    sums = each.select("path", "key", "n", "pos", *[F.sum(v).over(up_to).alias(c) for c, v in running.items()])

    def run(c: str, size: int) -> Column:
        return F.col(c) - F.coalesce(F.lag(c, size).over(up_to), F.lit(0))

    whole = sums.select(
        "path", "key", "n", "pos",
        *[run(f"s{k}", size).alias(f"s{k}") for k, size in enumerate(sizes)],
        *[run(c, size).alias(f"{c}{size}") for size in sorted(set(sizes)) for c in ("q", "m")],
    )
    fits = [
        F.when(((F.col("pos") + 1 >= size) | (F.col("pos") + 1 == F.col("n"))) & (F.col(f"m{size}") > 0) & (F.col(f"s{k}") >= (threshold - 1e-6) * F.sqrt(f"q{size}")),
               F.struct(F.lit(k).alias("k"), F.greatest(F.lit(1), F.col("pos") + 2 - size).alias("begin"), F.lit(size).alias("size")))
        for k, size in enumerate(sizes)
    ]
    runs = stored(whole.select("path", "key", F.explode(F.array_compact(F.array(*fits))).alias("r")).select("path", "key", "r.*"), "runs")
    # Runs and tokens of their texts meet in stretches of positions: a row is a token or a run.
    first, last = F.col("begin") - 1, F.col("begin") + F.col("size") - 2
    stretches = runs.withColumn("stretch", F.explode(F.sequence(F.shiftright(first, STRETCH), F.shiftright(last, STRETCH))))
    tokens = _marked(files, runs.select("path", "key").distinct()).select("path", "key", F.posexplode("tokens").alias("pos", "token"))
    tokens = tokens.withColumn("stretch", F.shiftright("pos", STRETCH))
    of = ["path", "key", "k", "begin"]
    inside = stretches.join(tokens, ["path", "key", "stretch"]).where(F.col("pos").between(first, last))
    counts = inside.groupBy(*of, "token").agg(F.count("*").alias("tf"))
    weighed = counts.join(F.broadcast(table), "token", "left").withColumn("v", F.col("tf") * idf)
    scored = weighed.groupBy(of).agg((F.coalesce(F.sum(F.col("v") * F.element_at("w", F.col("k") + 1)), F.lit(0.0)) / F.sqrt(F.sum(F.col("v") * F.col("v")))).alias("score"))
    name = F.element_at(F.array(*[F.lit(n) for n, _ in templates]), F.col("k") + 1)
    return scored.select("path", name.alias("license"), F.round("score", 6).alias("score"), (-F.col("k")).alias("first")).where(F.col("score") >= threshold)


def match_files(files: DataFrame, notice: str, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """For files (path, text) with a license of their own: path, license, score. A
    licence file that is a license as a whole has that; otherwise the best header
    counts, be it a line, a run of tokens or a long notice. Null and empty texts have none,
    repeated files give one row, an empty table none; paths are not null.

    The texts are read once: those with a marker word are stored for all matchers."""
    files = stored(files.where(F.lower("text").rlike(MARKER)).select("path", "text"), "marked")
    ranked = lambda df, rank: df.select("path", F.struct(F.lit(rank).alias("rank"), "score", "first", "license").alias("best"))
    every = [
        ranked(match_texts(files.where(F.col("path").rlike(notice))), 1),
        ranked(match_headers(files, templates, threshold).withColumn("first", F.lit(0)), 0),
        ranked(match_windows(files, templates or TEMPLATES, threshold), 0),
    ]
    if not templates:
        every.append(ranked(match_windows(files, long_notices(), TEXT_THRESHOLD).withColumn("first", F.col("first") - len(TEMPLATES)), 0))
    union = every[0]
    for df in every[1:]:
        union = union.unionByName(df)
    best = union.groupBy("path").agg(F.max("best").alias("best"))
    return best.select("path", "best.license", "best.score")


def folder_of(path: Column) -> Column:
    """The folder of a path ('' at the top)."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder, its parent and so on up to '', nearest first, as (depth, folder)."""
    parts = F.split(folder, "/")
    depth = F.when(folder == "", 0).otherwise(F.size(parts))
    return F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, 1, d), "/").alias("folder")))


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, notice: str = r"(^|/)(LICEN[CS]E|COPYING|NOTICE)[^/]*$") -> DataFrame:
    """The license of every file (path, text): path, license, score, basis, origin.

    basis: ``own`` (a header of the file, or a licence file that is a license as a
    whole), ``inherited`` (a licence file in the
    nearest folder above or beside it; ``origin`` is that folder) or ``none``. Of
    several licence files in a folder the best match counts, then the lesser path.
    Files of a path in common share one answer, the best of their texts. Null or
    empty text has no header and inherits; a null path has neither and is
    ``none``; an empty table gives no rows; other columns are ignored.
    """
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = match_files(files.where("path is not null and text is not null"), notice, templates, threshold)
    names = files.where("path is not null").select("path").distinct().withColumn("folder", folder_of(F.col("path")))
    marked = own.where(F.col("path").rlike(notice)).withColumn("folder", folder_of(F.col("path")))
    first = Window.partitionBy("folder").orderBy(F.desc("score"), "path")
    licensed = marked.withColumn("n", F.row_number().over(first)).where("n = 1").select("folder", F.col("license").alias("i_license"), F.col("score").alias("i_score"))
    # Inheritance by folder, not by file: a folder asks once however many files it has.
    above = names.select("folder").distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("up"))
    asked = above.select("folder", F.col("up.depth").alias("depth"), F.col("up.folder").alias("origin"))
    met = asked.join(licensed.withColumnRenamed("folder", "origin"), "origin")
    nearest = met.groupBy("folder").agg(F.max(F.struct("depth", "origin", "i_license", "i_score")).alias("got")).select("folder", "got.origin", "got.i_license", "got.i_score")
    resolved = names.join(own, "path", "left").join(nearest, "folder", "left")
    inherited = F.col("license").isNull() & F.col("i_license").isNotNull()
    answer = resolved.select(
        "path",
        F.coalesce("license", "i_license").alias("license"),
        F.coalesce("score", "i_score").alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(inherited, "inherited").otherwise("none").alias("basis"),
        F.when(inherited, F.col("origin")).alias("origin"),
    )
    nothing = files.where("path is null").select("path", *[F.lit(None).cast(t).alias(c) for c, t in (("license", "string"), ("score", "double"))], F.lit("none").alias("basis"), F.lit(None).cast("string").alias("origin"))
    return answer.unionByName(nothing)


def document_path() -> str:
    """SQL by which a document gets a path: its source, then folders by id; every
    eighth document is a licence file, some of them higher up. Null without source or id."""
    folder = "CASE WHEN doc_id % 64 = 0 THEN '' WHEN doc_id % 32 = 0 THEN 'b' || CAST(doc_id // 512 AS {s}) || '/' ELSE 'b' || CAST(doc_id // 512 AS {s}) || '/s' || CAST(doc_id // 64 % 8 AS {s}) || '/' END"
    return f"(source || '/' || {folder} || CASE WHEN doc_id % 8 = 0 THEN 'LICENSE-' ELSE 'f' END || CAST(doc_id AS {{s}}))"


def oracle() -> str:
    """The scan of all documents in DuckDB SQL."""
    idf, weights, other = template_weights(TEMPLATES)
    rows = ", ".join(f"('{t}', {v!r}, [{', '.join(repr(weights.get((k, t), 0.0)) for k in range(len(TEMPLATES)))}])" for t, v in idf.items())
    scores = ", ".join(f"{{'score': round(coalesce(sum(v * w[{k + 1}]), 0) / sqrt(sum(v * v)), 6), 'first': {-k}, 'license': '{name}'}}" for k, (name, _) in enumerate(TEMPLATES))
    return f"""
WITH weights(token, idf, w) AS (VALUES {rows}),
files AS (SELECT doc_id, text, {document_path().format(s='VARCHAR')} AS path FROM documents),
lines AS (SELECT path, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM files),
toks AS (
  SELECT path, pos, list_filter(regexp_split_to_array(regexp_replace(lower(line), '{EDGE}', ' ', 'g'), '{GAP}'), lambda t: t <> '') AS a
  FROM lines WHERE regexp_matches(lower(line), '{MARKER}')
),
tf AS (SELECT path, pos, token, count(*) AS n FROM (SELECT path, pos, unnest(a) AS token FROM toks) GROUP BY ALL),
weighed AS (SELECT path, pos, n * coalesce(idf, {other!r}) AS v, w FROM tf LEFT JOIN weights USING (token)),
best AS (SELECT path, list_max([{scores}]) AS best FROM weighed GROUP BY path, pos),
own AS (SELECT path, max(best).license AS license, max(best).score AS score FROM best GROUP BY path HAVING max(best).score >= {THRESHOLD}),
names AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS folder FROM files),
licensed AS (
  SELECT folder, license, score FROM own JOIN names USING (path) WHERE regexp_matches(path, '(^|/)(LICEN[CS]E|COPYING|NOTICE)[^/]*$')
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) = 1
),
nearest AS (
  SELECT n.folder, l.folder AS origin, l.license, l.score
  FROM (SELECT DISTINCT folder FROM names) n JOIN licensed l
    ON n.folder = l.folder OR l.folder = '' OR starts_with(n.folder, l.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY n.folder ORDER BY length(l.folder) DESC) = 1
)
SELECT n.doc_id, n.path, coalesce(o.license, i.license) AS license, coalesce(o.score, i.score) AS score,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN i.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
       CASE WHEN o.license IS NULL THEN i.origin END AS origin
FROM names n LEFT JOIN own o USING (path) LEFT JOIN nearest i ON n.folder = i.folder
"""


def scan_documents(docs: DataFrame) -> DataFrame:
    """The scan over documents by their derived paths, with doc_id. A document without id or
    source has no path and is ``none``."""
    path = F.expr(document_path().format(s="STRING").replace(" // ", " div "))
    files = docs.select("doc_id", path.alias("path"), "text")
    found = files.select("doc_id", "path").join(scan(files), "path", "left")
    return found.select("doc_id", "path", "license", "score", F.coalesce("basis", F.lit("none")).alias("basis"), "origin")
