"""Exact statistics that stay distributed."""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F


_ACCURACY = 1000


def exact_percentiles(
    df: DataFrame, column: str, fractions: list[float], keep: bool = True, settled_rows: int = 1_000_000
) -> list[float | None]:
    """Exact interpolated percentiles of one continuous column.

    ``percentile`` keeps every distinct value in one aggregation state, which grows
    with the data. Here each wanted rank has a bracket of values. While a bracket holds
    more than ``settled_rows`` rows, an approximate pass with a small state proposes a
    narrower one (about 4 in 1000 of it) and a counting pass proves it before it is
    taken. Only values inside the last brackets are ordered. The driver sees a handful
    of numbers. ``keep`` persists the one column between passes; turn it off where
    reading it again is cheap (a plain scan).
    """
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if not keep:
        return _percentiles(values, fractions, settled_rows)
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _percentiles(values, fractions, settled_rows)
    finally:
        values.unpersist()


@dataclass
class _Bracket:
    """Values lo..hi around a rank: ``below`` rows are smaller, ``upto`` are at most hi."""

    rank: float
    lo: float
    hi: float
    below: int
    upto: int
    margin: float = 2.0 / _ACCURACY

    @property
    def size(self) -> int:
        return self.upto - self.below

    def inside(self) -> Column:
        return F.col("v").between(self.lo, self.hi)

    def is_open(self, settled_rows: int) -> bool:
        return self.size > settled_rows and self.lo < self.hi and self.margin < 0.5

    def proposal(self) -> Column:
        at = (self.rank - self.below) / self.size
        edges = [max(0.0, at - self.margin), min(1.0, at + self.margin + 1.0 / self.size)]
        return F.percentile_approx(F.when(self.inside(), F.col("v")), edges, _ACCURACY)

    def take(self, lo: float, hi: float, below: int, upto: int) -> None:
        """The narrower bracket if it holds the rank and helps, else a wider next try."""
        if below <= math.floor(self.rank) and math.ceil(self.rank) < upto and upto - below < self.size:
            self.lo, self.hi, self.below, self.upto = lo, hi, below, upto
        else:
            self.margin *= 4.0


def _percentiles(values: DataFrame, fractions: list[float], settled_rows: int) -> list[float | None]:
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if n == 0:
        return [None] * len(fractions)
    brackets = [_Bracket(f * (n - 1), low, high, 0, n) for f in fractions]
    while todo := [b for b in brackets if b.is_open(settled_rows)]:
        edges = list(values.agg(*[b.proposal() for b in todo]).first())
        counts = values.agg(*[
            F.struct(F.count_if(F.col("v") < lo), F.count_if(F.col("v") <= hi)) for lo, hi in edges
        ]).first()
        for bracket, (lo, hi), (below, upto) in zip(todo, edges, counts):
            bracket.take(lo, hi, below, upto)
    wanted = reduce(operator.or_, [b.inside() for b in brackets])
    held = F.array_compact(F.array(*[F.when(b.inside(), F.lit(i)) for i, b in enumerate(brackets)]))
    counted = (
        values.where(wanted).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        .select("v", "n", F.explode(held).alias("i"))
    )
    w = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("c", F.sum("n").over(w))

    def at(i: int, rank: int) -> Column:
        return F.min(F.when((F.col("i") == i) & (F.col("c") > rank - brackets[i].below), F.col("v")))

    ends = running.agg(*[
        F.struct(at(i, math.floor(b.rank)), at(i, math.ceil(b.rank))) for i, b in enumerate(brackets)
    ]).first()
    return [lo + (hi - lo) * (b.rank - math.floor(b.rank)) for (lo, hi), b in zip(ends, brackets)]


def exact_median(df: DataFrame, column: str, keep: bool = True) -> float | None:
    return exact_percentiles(df, column, [0.5], keep)[0]


def sample_skewness(n: Column, m2: Column, m3: Column) -> Column:
    """Bias-corrected skewness from n and sums of central powers; null below 3 rows."""
    g1 = (m3 / n) / F.pow(m2 / n, F.lit(1.5))
    return F.when((n > 2) & (m2 > 0), g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(n: Column, m2: Column, m4: Column) -> Column:
    """Bias-corrected excess kurtosis; null below 4 rows."""
    g2 = (m4 / n) / (m2 / n * (m2 / n)) - 3
    return F.when((n > 3) & (m2 > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def safe_ratio(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """part * factor / whole, null for an empty whole."""
    return F.when(whole != 0, part * F.lit(factor) / whole)
