"""Running a function over Arrow batches of a few columns, some passed through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows handled at a time; an output batch never holds more input rows than this.
SLICE_ROWS = 256


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(df: DataFrame, keep: list[str], added: list[T.StructField]) -> T.StructType:
    """Kept columns of ``df`` followed by ``added``; an added name replaces a kept one."""
    new = {f.name for f in added}
    return T.StructType([df.schema[c] for c in keep if c not in new] + added)


def map_slices(
    df: DataFrame,
    inputs: list[str],
    keep: list[str],
    added: list[T.StructField],
    start: Callable[[], Callable[..., list]],
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """``start()`` once a task gives f(*columns as lists) -> one list for each added column.

    Only ``inputs`` and ``keep`` are read, so other columns of ``df`` may have any name.
    The kept columns pass through unchanged beside the added ones.
    """
    schema = schema_of(df, keep, added)
    names = schema.names
    new = [f.name for f in added]
    kinds = [_arrow(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            part = made = columns = None
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = work(*(part.column(c).to_pylist() for c in inputs))
                columns = {c: part.column(c) for c in keep if c not in new}
                columns |= {c: pa.array(v, k) for c, v, k in zip(new, made, kinds, strict=True)}
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
            del batch, part, made, columns
            pa.default_memory_pool().release_unused()  # workers live on between tasks

    wanted = list(dict.fromkeys([*inputs, *keep]))
    return df.select(*wanted).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
        T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return simple[kind]
