"""Numbers for rows in an order, without moving more than the order needs.

Numbering has two phases: rows lie in ordered runs (a range of a sort, a split of a
file) and know their place in the run; the runs are counted, the counts summed up, and
a row's number is its run's offset plus its place. Only the table of runs, a row for
each, is ever in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.session import stored

RUN, PLACE, FIRST, OFFSET, SIZE = "_run", "_place", "_first", "_offset", "_size"
_PLACE_BITS = 33  # of Spark's running id: the task above, the row in it below


def in_runs(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` sorted over the partitions and written with the run and place of each row.

    Written, so that what the runs are counted from is what is numbered. The order
    should end in something that tells equal rows apart, or a run may hold all of them.
    """
    placed = df.sort(*order).withColumn(PLACE, F.monotonically_increasing_id())
    return stored(placed, "runs").withColumn(RUN, F.shiftright(PLACE, _PLACE_BITS))


def run_offsets(runs: DataFrame, group: str | None = None) -> DataFrame:
    """A row for each run (and value of ``group``, if the runs are sorted by it first):
    its first place, the rows before it and the rows of the group in all."""
    by = [RUN] if group is None else [group, RUN]
    counts = runs.groupBy(*by).agg(F.min(PLACE).alias(FIRST), F.count(F.lit(1)).alias("_n"))
    part = Window.partitionBy(*by[:-1])
    before = part.orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    summed = counts.withColumn(OFFSET, F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # Written, so that its size is known when the join with it is planned.
    return stored(summed.withColumn(SIZE, F.sum("_n").over(part)).drop("_n"), "offsets")


def with_numbers(runs: DataFrame, offsets: DataFrame, into: str, group: str | None = None) -> DataFrame:
    """The rows of ``in_runs`` numbered from 0 in column ``into``, and what else
    ``offsets`` says of their run."""
    o = offsets.withColumnRenamed(RUN, "_run_of")
    same = F.col(RUN) == F.col("_run_of")
    if group is not None:
        o = o.withColumnRenamed(group, "_group_of")
        same &= F.col(group).eqNullSafe(F.col("_group_of"))
    number = (F.col(OFFSET) + F.col(PLACE) - F.col(FIRST)).alias(into)
    extra = [c for c in offsets.columns if c not in (RUN, FIRST, OFFSET, SIZE, group)]
    own = [c for c in runs.columns if c not in (RUN, PLACE)]
    return runs.join(o, same).select(*own, number, *extra)


def numbered(df: DataFrame, order: Sequence[Column], into: str) -> DataFrame:
    """``df`` with the number of each row in ``order``, from 0 without gaps."""
    runs = in_runs(df, order)
    return with_numbers(runs, run_offsets(runs), into)
