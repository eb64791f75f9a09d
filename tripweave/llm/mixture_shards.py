"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled by a seeded digest within their source and ranked there. A row's fraction is
its rank over the rows of its source, moved by a seeded start of that source; sorted by fraction,
every stretch of rows holds each source in proportion, so equal cuts give shards of the mixture.
Law: rows, so any two shards differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import cut

#: Parts of the digests, and of the fractions, ranked apart and put in order by their counts.
#: A power of 16; a source may have most of the rows, as its rows spread over all parts.
HEX_DIGITS = 3
PARTS = 16**HEX_DIGITS


def _hex(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _ranked(df: DataFrame, group: list[str], part: str, order: list[str], rank: str, total: str) -> DataFrame:
    """Ranks from 0 within ``group``, and its rows, through counts of ``part``s, which keep the order."""
    counts = df.groupBy(*group, part).agg(F.count("*").alias("_n"))
    span = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))  # PARTS rows
    before = span.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *group, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(span).alias(total)
    )
    within = Window.partitionBy(*group, part).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(within) - 1).join(counts, [*group, part]).withColumn(
        rank, F.col("_base") + F.col("_row")
    ).drop("_base", "_row")


def shard(
    df: DataFrame, shards: int, *, seed: int = 0, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot (gapless from 0 in each shard) for every row.

    size is the text's UTF-8 bytes plus 1; a null text has none. A null source is a source of its
    own. Rows with equal doc_id, source and text are interchangeable: each has its own slot. With
    fewer rows than shards some shards stay empty; no rows give none. Other columns are not read.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), name.alias("_stratum"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn(
        "_digest", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text_crc32").cast("string")))
    ).withColumn("_part", _hex(F.col("_digest"), HEX_DIGITS))
    order = ["_digest", "doc_id", "size"]
    ranked = _ranked(cut(rows), ["_stratum"], "_part", order, "_rank", "_rows")
    start = (_hex(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_stratum"))), 8) + 0.5) / float(2**32)
    ranked = ranked.withColumn("_fraction", (F.col("_rank") + start) / F.col("_rows")).withColumn(
        "_part", F.floor(F.col("_fraction") * float(PARTS))
    ).drop("_rank", "_rows")
    # fixed once: the fractions are read for their counts and again for the ranks
    placed = _ranked(cut(ranked), [], "_part", ["_fraction", "_stratum", *order], "_rank", "_rows")
    number = F.expr(f"_rank * {shards} div _rows")
    return placed.withColumn("shard", number.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "shard",
        (F.col("_rank") - F.expr(f"(shard * _rows + {shards - 1}) div {shards}")).alias("slot"),
    )
