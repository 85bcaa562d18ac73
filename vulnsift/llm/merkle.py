"""Merkle manifest of a dataset (operator 11): a tree for each group, a tree over their roots.

A row's leaf is the hash of its fields; in each group the leaves lie in order, and every
two nodes (at a level's end a single one) become their parent until one is left,
the group's root. The group roots, in order of the group (null first), make a
tree in the same way; its root is the dataset's.

Levels are built nine at a time: a task hashes the subtrees over up to 512 nodes and
stores, for each node that they start from, a **node row** with the siblings that its
path to the next such node needs, and that node as its parent. A group's last node row goes on
through the tree of group roots. A recursive query then climbs from each leaf: it joins
a leaf's parent link with the node row there, appends the siblings to the proof and folds
them into the hash, until it reaches the root. A climb takes a round for every factor of
512 in the number of rows, which is what keeps its shuffles in proportion to the rows.

Many leaves pass the upper nodes: they are stored once for every block of 512 leaves
below them, so a join key has at most that many rows whatever the group's size. Leaves are numbered by runs (``operators.numbering``), so a group may be
of any size and need not fit in a task.

Odd input: null fields are ``-``; null ids come first, a null group is a group; rows with the
same order are taken by their hash, so repeated rows give the same root in any order of
the input; an empty table gives an empty manifest; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnsift.llm.common import stored
from vulnsift.operators.numbering import in_runs, numbered, run_offsets, with_numbers

STRIDE = 9  # levels that a node row spans, and height of the blocks that climb together


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(values: Sequence[Column]) -> Column:
    """The leaf of a row, 32 bytes."""
    return digest(F.concat(*[field_text(v) for v in values]))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hex_of(hashed: Column) -> Column:
    return F.lower(F.hex(hashed))


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of so many."""
    return F.when(size <= 1, F.lit(0)).otherwise(F.length(F.bin(size - 1)))


def _strides(size: Column) -> Column:
    """Node rows on the way up such a tree, at least one."""
    return F.greatest(F.lit(1), F.ceil(_height(size) / STRIDE)).cast("int")


def _pairs(level: str) -> Column:
    def parent(i: Column) -> Column:
        left, right = F.get(F.col(level), 2 * i), F.get(F.col(level), 2 * i + 1)
        return digest(F.concat(hex_of(left), F.coalesce(hex_of(right), F.lit(""))))

    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)), parent)


def _climb_stride(nodes: DataFrame, step: int, payload: Sequence[str] = ()) -> DataFrame:
    """Nodes ``tree, at, hash, size`` of one level (and payload columns) with their
    ``siblings`` on up to ``STRIDE`` levels and ``top``, the node that these lead to."""
    member = F.struct("at", "hash", *payload)
    block = F.shiftright("at", STRIDE).alias("block")
    groups = nodes.groupBy("tree", "size", block).agg(F.array_sort(F.collect_list(member)).alias("members"))
    groups = groups.withColumn("levels", F.least(F.lit(STRIDE), _height(F.col("size")) - STRIDE * step))
    groups = groups.withColumn("l0", F.transform("members", lambda m: m["hash"]))
    for k in range(STRIDE):
        groups = groups.withColumn(f"l{k + 1}", F.when(F.col("levels") > k, _pairs(f"l{k}")))
    top = F.coalesce(*[F.get(f"l{k}", F.lit(0)) for k in range(STRIDE, -1, -1)])
    rows = groups.select("tree", "size", "levels", *[f"l{k}" for k in range(STRIDE)], top.alias("top"), F.posexplode("members").alias("i", "m"))
    on_levels = [F.get(f"l{k}", F.shiftright("i", k).bitwiseXOR(F.lit(1))) for k in range(STRIDE)]
    siblings = F.slice(F.array(*on_levels), F.lit(1), F.col("levels"))
    return rows.select("tree", "size", "m.*", siblings.alias("siblings"), "top")


def _tree(leaves: DataFrame, strides: int, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The node rows of each stride, leaves first."""
    built: list[DataFrame] = []
    level = leaves
    for step in range(strides):
        rows = stored(_climb_stride(level, step, payload if step == 0 else ()), "nodes")
        built.append(rows.withColumn("step", F.lit(step)))
        above = _height(F.col("size")) > STRIDE * (step + 1)
        first = F.col("at").bitwiseAND(F.lit((1 << STRIDE) - 1)) == 0
        level = rows.where(above & first).select("tree", "size", F.shiftright("at", STRIDE).alias("at"), F.col("top").alias("hash"))
    return built


def _roots(built: Sequence[DataFrame]) -> DataFrame:
    last = [n.where((F.col("at") == 0) & (F.col("step") == _strides(F.col("size")) - 1)).select("tree", "top") for n in built]
    roots = last[0]
    for more in last[1:]:
        roots = roots.unionAll(more)
    return roots


@dataclass
class Manifest:
    """``leaves``: a node row for each row of the data, with its key, its hash and the
    hash claimed for it; ``nodes``: the node rows above; ``groups``: ``group,
    size, subroot``. Together they prove any row."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    steps: int


def build_manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, claimed: Column | None = None) -> Manifest:
    """The stored manifest of ``rows``. ``claimed`` is the leaf that each row is to be
    verified with later (its own by default)."""
    own = row_hash([F.col(f) for f in fields])
    leaves = rows.select(
        F.col(group).alias("group"), F.col(order).alias("key"), own.alias("hash"),
        (own if claimed is None else F.coalesce(claimed, own)).alias("claimed"),
    )
    # The running id keeps equal rows from falling into one run.
    runs = in_runs(leaves.withColumn("tie", F.monotonically_increasing_id()), [F.col(c) for c in ("group", "key", "hash", "tie")]).drop("tie")
    offsets = run_offsets(runs, "group")
    groups = numbered(offsets.groupBy("group").agg(F.first("_size").alias("size")), [F.col("group")], "tree")
    groups = stored(groups, "groups")
    known = offsets.join(groups.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g"))).drop("g")
    placed = with_numbers(runs, stored(known, "offsets"), "at", "group")
    longest, n_groups = groups.agg(F.max("size"), F.count(F.lit(1))).first()
    built = _tree(placed.select("tree", "at", "hash", "size", "key", "claimed"), _n_strides(longest or 1), ["key", "claimed"])
    subroots = stored(_roots(built).withColumnRenamed("top", "subroot"), "subroots")
    forest = _tree(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("subroot").alias("hash"), F.lit(n_groups).cast("long").alias("size")),
        _n_strides(n_groups),
    )
    sized = stored(_forest_paths(groups.join(subroots, "tree"), forest), "paths")
    nodes = stored(_node_rows(built[1:], sized), "nodes")
    return Manifest(built[0], nodes, sized.select("group", "size", "subroot"), len(built) + 1)


def _n_strides(size: int) -> int:
    return max(1, -(-max(0, size - 1).bit_length() // STRIDE))


def _forest_paths(groups: DataFrame, forest: Sequence[DataFrame]) -> DataFrame:
    """The groups with the siblings of their path through the tree of group roots, and its root."""
    paths = groups.withColumn("path", F.array().cast("array<binary>"))
    for k, rows in enumerate(forest):
        root = F.col("top").alias("root")
        above = rows.select(F.col("at").alias("node"), F.col("siblings").alias("more"), *([root] if k + 1 == len(forest) else []))
        paths = paths.join(above, F.shiftright("tree", STRIDE * k) == F.col("node"))
        paths = paths.withColumn("path", F.concat("path", "more")).drop("node", "more")
    return paths


def _node_rows(upper: Sequence[DataFrame], groups: DataFrame) -> DataFrame:
    """Node rows ``tree, step, block, at, siblings`` above the leaves' own, each once for every
    block that passes it. The last of a path goes on to the root and knows the roots; in
    a group of one block that is all it does."""
    null = F.lit(None).cast("binary")
    single = groups.where(_strides(F.col("size")) == 1)
    parts = [single.select("tree", F.lit(1).alias("step"), F.lit(0).cast("long").alias("block"), F.col("tree").alias("at"), F.col("path").alias("siblings"), "subroot", "root")]
    ends = groups.select("tree", "path", "subroot", "root")
    for step, rows in enumerate(upper, 1):
        beyond = STRIDE * (step - 1)  # a node here covers 2^beyond blocks
        last = F.least(F.shiftleft(F.col("at") + 1, beyond), F.shiftright(F.col("size") - 1, STRIDE) + 1) - 1
        rows = rows.select("*", F.explode(F.sequence(F.shiftleft("at", beyond), last)).alias("block"))
        top = _strides(F.col("size")) == step + 1
        through = rows.where(~top).select("tree", "step", "block", "at", "siblings", null.alias("subroot"), null.alias("root"))
        # Sides are the bits of ``at``: below those of the group's tree, above those of the groups'.
        on = rows.where(top).join(ends, "tree").withColumns(
            {"at": F.col("at") + F.expr("shiftleft(tree, size(siblings))"), "siblings": F.concat("siblings", "path")}
        )
        parts += [through, on.select("tree", "step", "block", "at", "siblings", "subroot", "root")]
    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionAll(more)
    return nodes


_FOLD = """aggregate(transform({siblings}, (s, i) -> struct(s AS s, shiftright({at}, i) & 1 AS odd)), {hash}, (h, x) -> unhex(sha2(CASE
  WHEN x.s IS NULL THEN lower(hex(h)) WHEN x.odd = 1 THEN concat(lower(hex(x.s)), lower(hex(h))) ELSE concat(lower(hex(h)), lower(hex(x.s))) END, 256)))"""
_APPEND = "aggregate(filter({siblings}, s -> s IS NOT NULL), {proof}, (p, s) -> concat(p, s))"
CLIMB = """
WITH RECURSIVE climb(key, leaf, tree, step, block, folded, proof, subroot, root) AS (
  SELECT key, hash, tree, 1, shiftright(at, {stride}), {first_fold}, {first_proof},
         CAST(NULL AS BINARY), CAST(NULL AS BINARY)
  FROM {leaves}
  UNION ALL
  SELECT c.key, c.leaf, n.tree, n.step + 1, n.block, {fold}, {proof}, n.subroot, n.root
  FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.step = c.step AND n.block = c.block
  WHERE c.root IS NULL
)
SELECT key, leaf, subroot, root, proof, folded, folded = root AS verified FROM climb WHERE root IS NOT NULL
"""


@contextmanager
def _whole_recursion(spark: SparkSession, rounds: int) -> Iterator[None]:
    """Spark stops a recursive query at a number of rows; a climb returns all it has."""
    settings = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(rounds + 2)}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def verify_rows(manifest: Manifest) -> DataFrame:
    """One row for each leaf: ``key``, its ``leaf``, ``subroot``, ``root``, the ``proof`` (the
    siblings one after another, 32 bytes each), ``folded``, the root that the claimed leaf
    leads to, and ``verified``, whether it is the true one. All hashes are bytes."""
    spark = manifest.leaves.sparkSession
    terms = {
        "stride": str(STRIDE),
        "first_fold": _FOLD.format(siblings="siblings", at="at", hash="claimed"), "first_proof": _APPEND.format(siblings="siblings", proof="X''"),
        "fold": _FOLD.format(siblings="n.siblings", at="n.at", hash="c.folded"), "proof": _APPEND.format(siblings="n.siblings", proof="c.proof"),
    }
    query = CLIMB.format(**terms, leaves="{leaves}", nodes="{nodes}")
    with _whole_recursion(spark, manifest.steps):
        return stored(spark.sql(query, leaves=manifest.leaves, nodes=manifest.nodes), "proofs")
