from __future__ import annotations

import pytest
from pyspark.sql import types as T

# extra columns whose names operators use for their own
CLASHING = ("score", "ids", "n_tokens", "shard", "slot", "found", "kept", "node", "text_crc32", "length", "_part", "severity")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) to documents, with columns of clashing names beside them."""

    def build(rows):
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
            + [T.StructField(c, T.StringType()) for c in CLASHING]
        )
        full = [(*r, None)[:3] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame([(*r, *("x" for _ in CLASHING)) for r in full], schema)

    return build


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Null, empty, blank, very long, repeated and tied rows."""
    long = "word " * 30_000 + "end"
    return docs_of([
        (1, "one two three four five six seven", "a"), (2, None, "a"), (3, "", None), (4, " \n\t ", "b"), (5, long, "b"),
        (6, "one two three four five six seven", "a"), (6, "one two three four five six seven", "a"), (None, "no id here at all", "a"),
        (7, "a", "c"), (8, "é ▁ 日本 🙂 <|endoftext|> <s>  x ", "c"), (-9, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "c"),
    ])
