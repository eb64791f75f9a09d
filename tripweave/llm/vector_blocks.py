"""Vectors in blocks of bounded size, and the search of query blocks in them.

Rows are numbered once and dealt to blocks by a hash of that number, so neither a repeated id nor a
repeated vector makes a block large. Each block gets an index of its own, made once and kept as one
row, and stays where it is: the small blocks of queries travel to every block of rows and are
searched there one after the other. Vectors of other lengths never meet.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import cut

#: Rows in a block on average, of candidates and of queries.
BLOCK_ROWS, QUERY_ROWS = 8192, 512


def finite(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _dealt(rows: DataFrame, sizes: DataFrame, parts: str, number: str) -> DataFrame:
    return rows.join(F.broadcast(sizes), "dim").select(
        "dim", F.pmod(F.xxhash64(number), parts).cast("int").alias("block"), "id", "vector"
    )


def _packed(rows: DataFrame, kind: str, index: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """One row for each block with the arrays that ``index`` makes of its ids and vectors."""

    def pack(table: pa.Table) -> pa.Table:
        flat = table.column("vector").combine_chunks()
        vectors = np.asarray(flat.flatten(), dtype=kind).reshape(len(flat), -1)
        ids = np.asarray(table.column("id"), dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        out = io.BytesIO()
        np.savez(out, **index(ids[order], vectors[order]))
        return pa.table({
            "dim": table.column("dim")[:1], "block": table.column("block")[:1], "arrays": pa.array([out.getvalue()], pa.binary())
        })

    return rows.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, arrays binary")


def search(
    rows: DataFrame,
    is_query: Column,
    k: int,
    *,
    kind: str,
    score_type: str,
    index: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]],
    find: Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray, int], Iterator[tuple[int, np.ndarray, np.ndarray]]],
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best, ties to the smaller vec_id.

    ``rows`` has id, dim and vector (at least one component). ``index`` makes a block's arrays;
    ``find(arrays, query ids, query vectors, k)`` gives (query id, ids, scores) of its best k rows
    or more, without those of the query's own id. A repeated query id is searched once.
    """
    rows = cut(rows.withColumn("number", F.monotonically_increasing_id()))  # numbers of written rows stay
    parts = lambda n, per_block: F.greatest(F.ceil(n / per_block), F.lit(1)).cast("int")
    sizes = cut(rows.groupBy("dim").agg(
        parts(F.count("*"), BLOCK_ROWS).alias("blocks"), F.count_if(is_query).alias("queries")
    ).where("queries > 0").withColumn("asked", parts(F.col("queries"), QUERY_ROWS)))
    total = sizes.agg(F.coalesce(F.sum("blocks"), F.lit(1))).first()[0]
    # a row for each vector length: n different lengths need n * n / 2 components, so these are few
    blocks = _packed(_dealt(rows, sizes, "blocks", "number"), kind, index)
    asked = rows.where(is_query).groupBy("dim", "id").agg(F.min("vector").alias("vector"))
    plain = lambda ids, vectors: {"ids": ids, "vectors": vectors}
    asked = _packed(_dealt(asked, sizes, "asked", "id"), kind, plain)
    home = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    sent = asked.join(F.broadcast(sizes.select("dim", "blocks")), "dim").select(
        "dim", home, F.col("block").alias("query_block"), "arrays"
    )
    met = blocks.select("dim", "block", F.lit(-1).alias("query_block"), "arrays").unionByName(sent)
    pairs = met.repartition(int(total), "dim", "block").sortWithinPartitions("dim", "block", "query_block").select("query_block", "arrays")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                arrays = np.load(io.BytesIO(batch.column(1)[i].as_py()))
                if batch.column(0)[i].as_py() < 0:  # the rows' block comes before the queries that visit it
                    block = dict(arrays)
                    continue
                found = list(find(block, arrays["ids"], arrays["vectors"], k))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([np.full(len(ids), q) for q, ids, _ in found]), pa.int64()),
                        pa.array(np.concatenate([ids for _, ids, _ in found]), pa.int64()),
                        pa.array(np.concatenate([scores for _, _, scores in found])),
                    ], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]
