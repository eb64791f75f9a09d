"""Right-closed binning from an edge list; an open last edge is ``None``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def bin_no(value: Column, edges: Sequence[float | None]) -> Column:
    """Index of the bin with ``edge[i] < value <= edge[i+1]``; null outside all bins."""
    chain = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        hit = value > F.lit(float(lo))
        if hi is not None:
            hit = hit & (value <= F.lit(float(hi)))
        chain = F.when(hit, i) if chain is None else chain.when(hit, i)
    return chain


def bins_table(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """bin_no, label; one partition, built inside Spark."""
    texts = F.array(*[F.lit(text) for text in labels])
    numbers = spark.range(0, len(labels), 1, 1).select(F.col("id").cast("int").alias("bin_no"))
    return numbers.withColumn("label", F.element_at(texts, F.col("bin_no") + 1))


def histogram(
    df: DataFrame, column: str, edges: Sequence[float | None], labels: Sequence[str]
) -> DataFrame:
    """bin_no, label, n for every bin, empty ones too."""
    counts = (
        df.select(bin_no(F.col(column), edges).alias("bin_no"))
        .where(F.col("bin_no").isNotNull())
        .groupBy("bin_no")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        bins_table(df.sparkSession, labels)
        .join(F.broadcast(counts), "bin_no", "left")  # one row per bin
        .select("bin_no", "label", F.coalesce("n", F.lit(0)).alias("n"))
    )
