"""The corpus pipeline: toxicity, quality, near-duplicates, secrets, packing.

Every stage takes the documents that the one before kept and all but the last return their
columns. A stage's rows are written as Parquet and read again before the next one starts, so a
lost executor costs the work of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import bottomk_dedup, ordinal_toxicity, quality_crf, secret_battery
from tripweave.llm.batches import read
from tripweave.llm.queries import GOOD, packed_documents
from tripweave.session import cut, scratch_path

#: Near-duplicates: words in a shingle, and the similarity in hundredths.
WORDS, PERCENT = 5, 80


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, list[str]]:
    """The documents with numbered columns, so that no added column can clash; the text's name."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("text")], names


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; null and empty texts stay."""
    model = ordinal_toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows, text, names = _numbered(docs)
    return ordinal_toxicity.score(rows, model, text=text, keep=names).where(~F.col("toxic")).select(*names).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality, by the labels that op1_quality learns from too."""
    model = quality_crf.fit(docs, read(spark, sf_dir, "labels").where(~quality_crf.held_out()))
    rows, text, names = _numbered(docs)
    return quality_crf.score(rows, model, text=text, keep=names).where(F.col("score") >= GOOD).select(*names).toDF(*docs.columns)


def _text_numbers(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` plus _number, a 64-bit number for each different text: its hash, hashed again where two texts share one."""
    rows = rows.withColumns({"_number": F.xxhash64(text), "_digest": F.md5(F.col(text).cast("binary"))})
    salt = 0
    while True:
        shared = cut(rows.groupBy("_number").agg(
            F.min("_digest").alias("low"), F.max("_digest").alias("high")
        ).where("low < high").select("_number", F.lit(True).alias("_again")))
        if shared.isEmpty():
            return rows.drop("_digest")
        salt += 1
        rows = rows.join(shared, "_number", "left").withColumn(
            "_number", F.when(F.col("_again"), F.xxhash64("_digest", F.lit(salt))).otherwise(F.col("_number"))
        ).drop("_again")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: of the smallest doc_id, rows without one last.

    Decided by texts, whatever ids they have: unrelated texts under one doc_id both stay, copies
    without doc_id leave one. Rows of one doc_id and equal texts are ordered by a hash of all columns,
    of rows equal in all one stays. Texts without words stay.
    """
    rows, text, names = _numbered(docs)
    has_words = F.coalesce(F.col(text).rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    doc_id = F.col(names[docs.columns.index("doc_id")])
    key = ["_number", "_last", "_id", "_row"]
    filled = _text_numbers(rows.where(has_words), text).withColumns({
        "_last": doc_id.isNull(), "_id": F.coalesce(doc_id.cast("long"), F.lit(0)), "_row": F.xxhash64(*names),
    })
    found = bottomk_dedup.near_duplicates(filled, words=WORDS, percent=PERCENT, doc_id="_number", text=text)
    groups = found.select(F.col("doc_id").alias("_number"), F.col("component_id").alias("_group")).distinct()
    first = filled.groupBy(*key).agg(F.count("*").alias("_n")).groupBy("_number").agg(
        F.min(F.struct("_last", "_id", "_row", "_n")).alias("first")
    )
    kept = cut(first.join(groups, "_number").groupBy("_group").agg(
        F.min(F.struct("first", "_number")).alias("k")
    ).select("k._number", "k.first.*"))
    out = filled.join(kept, key, "left_semi")
    if not kept.where("_n > 1").isEmpty():
        repeated = kept.where("_n > 1")
        out = filled.join(kept.where("_n = 1"), key, "left_semi").unionByName(
            filled.join(repeated, key, "left_semi").dropDuplicates(["_number"])
        )
    return out.select(*names).unionByName(rows.where(~has_words)).toDF(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars counted again where they were."""
    rows, text, names = _numbered(docs)
    out = secret_battery.redact(rows, text=text, keep=names)
    if "n_chars" in docs.columns:
        chars = names[docs.columns.index("n_chars")]
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(chars, F.when(F.col("n_spans") > 0, F.length(text).cast(kind)).otherwise(F.col(chars)))
    return out.select(*names).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence."""
    return packed_documents(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: No stage but the last could be stated in SQL, and none of the fitted models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
