"""Per-vehicle ordering that survives a vehicle holding a large share of all pings.

A window over one vehicle's day is one task. That is right for ordinary vehicles
(a few thousand pings) and wrong for a broken device id that collects billions.
``sequence`` counts pings per vehicle-day first (map-side combined, two columns
read). Days above ``max_rows_per_task`` are cut into consecutive chunks by a range
partitioning on the full order, fixed with a checkpoint; all other rows keep chunk
-1 and their single window. Operators then work per (vehicle, day, chunk) and take
what they need from neighbouring chunks out of a carry table with one row per
chunk, so no task ever holds a whole hot vehicle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec, functions as F

from tripweave.params import DEFAULTS, Params
from tripweave.session import cut

KEYS = ("vehicle_id", "service_date")
ORDER = ("sec_of_day", "seq")
CHUNK = "chunk"


@dataclass(frozen=True)
class Sequence:
    df: DataFrame
    chunks: int  # number of chunks of split vehicle-days; 0 when nothing was split
    params: Params
    hot_days: int = 0  # vehicle-days that were split

    @property
    def split(self) -> bool:
        return self.chunks > 0

    @property
    def group(self) -> tuple[str, ...]:
        return (*KEYS, CHUNK) if self.split else KEYS

    def on(self, df: DataFrame) -> Sequence:
        """The same chunking over rows derived from these."""
        return replace(self, df=df)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*ORDER)

    def backward(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*[F.desc(c) for c in ORDER])

    def frame(self) -> WindowSpec:
        """The whole group; ordered all the same, so that it shares the one sort."""
        return self.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def carry(
        self,
        df: DataFrame,
        summary: list[Column],
        stages: Callable[[WindowSpec, WindowSpec], list[dict[str, Column]]],
    ) -> DataFrame:
        """Add columns computed from the other chunks of the same vehicle-day.

        ``summary`` aggregates one chunk. ``stages(before, after)`` returns column
        dictionaries applied in turn to the chunk rows; those of the last one are
        joined back. ``before`` frames all earlier chunks, nearest last; ``after``
        all later chunks, nearest last too (it runs backwards, because a frame
        that starts at the current row is quadratic in Spark).
        """
        table = df.where(F.col(CHUNK) >= 0).groupBy(*KEYS, CHUNK).agg(*summary)
        by_day = Window.partitionBy(*KEYS)
        before = by_day.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        after = by_day.orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
        plan = stages(before, after)
        for cols in plan:
            table = table.withColumns(cols)
        table = table.select(*KEYS, CHUNK, *plan[-1])
        if self.chunks + self.hot_days <= self.params.max_broadcast_rows:
            table = F.broadcast(table)  # one row per chunk, and one more per split day at most
        return df.join(table, [*KEYS, CHUNK], "left")


def listed(rare: DataFrame, most: int) -> list[Row] | None:
    """The rows of a table that is small as a rule, or None where there are more than ``most``.

    They are counted first, in all partitions at once: a limit alone looks into one partition, then
    a few, then the rest, one after the other.
    """
    rare = rare.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rare.count()
        return None if n > most else rare.collect() if n else []
    finally:
        rare.unpersist()


def sequence(
    pings: DataFrame, p: Params = DEFAULTS, source: DataFrame | None = None, counts: DataFrame | None = None
) -> Sequence:
    """Order pings inside vehicle-days, cutting oversized days into chunks.

    ``source`` may name the pings before they were filtered: counting those reads
    the key columns only, and a count that is too high does no harm. ``counts`` hands
    over such a count (keys and ``n``) where there is one. Pings without a vehicle
    belong to no sequence.
    """
    pings = pings.where(F.col(KEYS[0]).isNotNull())
    if counts is None:
        counts = (pings if source is None else source).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where((F.col("n") > p.max_rows_per_task) & F.col(KEYS[0]).isNotNull())
    hot = listed(counts, p.max_hot_keys)
    if hot == []:
        return Sequence(pings, 0, p)
    spark = pings.sparkSession
    if hot is not None:
        keys = F.broadcast(
            spark.createDataFrame(
                [(r[KEYS[0]], r[KEYS[1]]) for r in hot],
                pings.select(*KEYS).schema,
            )
        )
        rows, days = sum(r["n"] for r in hot), len(hot)
    else:  # too many to list: a table of their own
        keys = cut(counts)
        rows, days = keys.agg(F.sum("n"), F.count(F.lit(1))).first()
        keys = keys.select(*KEYS)
    cold = pings.join(keys, list(KEYS), "left_anti")
    dense = pings.join(keys, list(KEYS), "left_semi")
    n = -(-rows // p.max_rows_per_task)
    dense = cut(
        dense.select(*pings.columns)
        .repartitionByRange(int(n), *KEYS, *ORDER)
        .withColumn(CHUNK, F.spark_partition_id())
    )
    dense = cold.select(*pings.columns).withColumn(CHUNK, F.lit(-1)).unionByName(dense)
    return Sequence(dense, int(n), p, int(days))
