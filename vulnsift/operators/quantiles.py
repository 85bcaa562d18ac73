"""Exact order statistics of columns with any number of different values.

A value of a given rank is found by narrowing its range: approximate percentiles (a sketch
of bounded size) give two values of the data close around the rank, an exact count says
below, at, between or above which of them the rank lies, and the next round looks
only there. A round narrows a range by a factor of some thousands, whatever the
distribution; once few values are left in a range they are gathered and the rank is read
off. Where there are more than ``gather`` rows, the columns are written once before (numbers only), so the passes
don't compute them again. So no task and no buffer ever holds more than ``GATHER`` values of a range, and all ranks of
all columns share the passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnsift.session import stored

GATHER = 20_000
ACCURACY = 10_000  # of the percentile sketch: its rank is off by at most 1 in so many


@dataclass(frozen=True)
class Range:
    """Values of ``column`` strictly between two values of the data (None: no bound):
    so many, and ``below`` before them."""

    column: str
    low: float | None
    high: float | None
    below: int
    size: int

    def holds(self, v: Column) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside &= v > F.lit(self.low)
        if self.high is not None:
            inside &= v < F.lit(self.high)
        return inside


def order_statistics(
    df: DataFrame, columns: dict[str, Column], ranks: Callable[[int], dict[str, Sequence[int]]], gather: int = GATHER, accuracy: int = ACCURACY
) -> tuple[int, dict[tuple[str, int], float]]:
    """The number of rows and the values at the wanted ranks.

    ``ranks`` says for the number of rows which ranks (from 1) of which columns are
    wanted; ranks outside the rows have no value. The columns must not be null; NaN counts as the
    greatest value.
    """
    n = df.count()
    values = df.select(*[c.cast("double").alias(name) for name, c in columns.items()])
    if n > gather:
        values = stored(values, "order-values")
    open_ = {(name, r): Range(name, None, None, 0, n) for name, rs in ranks(n).items() for r in rs if 1 <= r <= n}
    found: dict[tuple[str, int], float] = {}
    while open_:
        small = {x for x in open_.values() if x.size <= gather}
        if small:
            found |= _gathered(values, {k: x for k, x in open_.items() if x in small})
            open_ = {k: x for k, x in open_.items() if x not in small}
        if open_:
            hit, open_ = _narrowed(values, open_, accuracy)
            found |= hit
    return n, found


def _gathered(values: DataFrame, targets: dict[tuple[str, int], Range]) -> dict[tuple[str, int], float]:
    ranges = sorted(set(targets.values()), key=str)
    row = values.agg(*[F.array_sort(F.collect_list(F.when(x.holds(F.col(x.column)), F.col(x.column)))).alias(f"r{i}") for i, x in enumerate(ranges)]).first()
    return {k: row[f"r{ranges.index(x)}"][k[1] - x.below - 1] for k, x in targets.items()}


def _narrowed(values: DataFrame, targets: dict[tuple[str, int], Range], accuracy: int) -> tuple[dict, dict]:
    keys = list(targets)
    near = []
    for i, k in enumerate(keys):
        x = targets[k]
        at = (k[1] - x.below) / x.size
        around = [min(1.0, max(0.0, at + side * 1.5 / accuracy)) for side in (-1, 1)]
        near.append(F.percentile_approx(F.when(x.holds(F.col(x.column)), F.col(x.column)), around, accuracy).alias(f"p{i}"))
    bounds = values.agg(*near).first()
    counts = []
    for i, k in enumerate(keys):
        v, inside = F.col(targets[k].column), targets[k].holds(F.col(targets[k].column))
        for j, b in enumerate(bounds[f"p{i}"]):
            counts += [F.count_if(inside & (v < F.lit(b))).alias(f"lt{i}_{j}"), F.count_if(inside & (v <= F.lit(b))).alias(f"le{i}_{j}")]
    row = values.agg(*counts).first()
    found, open_ = {}, {}
    for i, k in enumerate(keys):
        x, (a, b) = targets[k], bounds[f"p{i}"]
        r = k[1] - x.below
        lt_a, le_a, lt_b, le_b = (row[f"{c}{i}_{j}"] for j in (0, 1) for c in ("lt", "le"))
        if r <= lt_a:
            open_[k] = replace(x, high=a, size=lt_a)
        elif r <= le_a:
            found[k] = a
        elif r <= lt_b:
            open_[k] = Range(x.column, a, b, x.below + le_a, lt_b - le_a)
        elif r <= le_b:
            found[k] = b
        else:
            open_[k] = replace(x, low=b, below=x.below + le_b, size=x.size - le_b)
    return found, open_
