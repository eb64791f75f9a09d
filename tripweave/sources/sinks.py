"""Writers: files, keyed tables, JDBC, and versioned publication of a result set."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.functions.clock import format_seconds
from tripweave.schemas import RESULT_TABLES

VERSIONS, COMPACTED = "_versions", "_compacted"
_MARK = "version long, attempt string, published_at timestamp_ntz"


def od_columns(trips: DataFrame) -> DataFrame:
    """Trips under the exchange names, times as HH:MM:SS."""
    return trips.select(
        F.col("vehicle_id").alias("VehicleNum"),
        format_seconds(F.col("s_sec")).alias("Stime"),
        F.col("s_lng").alias("SLng"), F.col("s_lat").alias("SLat"),
        F.col("e_lng").alias("ELng"), F.col("e_lat").alias("ELat"),
        format_seconds(F.col("e_sec")).alias("Etime"),
        "duration_min", "distance_km", "avg_speed", "trip_id",
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replaces the table, or of a partitioned one the partitions that ``df`` has rows for."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def check_schema(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a result table, in order.

    Raises on a missing column or a type that differs; never drops a target.
    """
    schema, _ = RESULT_TABLES[table]
    have = {f.name.lower(): f for f in df.schema}
    problems = []
    for field in schema:
        found = have.get(field.name.lower())
        if found is None:
            problems.append(f"{field.name} is missing")
        elif found.dataType != field.dataType:
            problems.append(f"{field.name} is {found.dataType.simpleString()}, not {field.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{table}: " + "; ".join(problems))
    return df.select(*[F.col(have[f.name.lower()].name).alias(f.name) for f in schema])


def merge_latest(existing: DataFrame, new: DataFrame, keys: list[str], updated: str = "updated_at") -> DataFrame:
    """Upsert: per key the row updated last; among equals the new one wins.

    An aggregation instead of a ranking, so repeated keys shrink before the shuffle.
    """
    rest = [c for c in existing.columns if c not in keys]
    both = existing.withColumn("v", F.lit(0)).unionByName(new.select(*existing.columns).withColumn("v", F.lit(1)))
    last = F.max_by(F.struct(*rest), F.struct(F.col(updated), F.col("v"), F.struct(*rest)))
    return both.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*").select(*existing.columns)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 1000) -> None:
    """Replace the rows of a database table, keeping its definition."""
    df.write.option("truncate", True).option("batchsize", batch).jdbc(
        url, table, mode="overwrite", properties=properties
    )


def merge_keyed(existing: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """Upsert by the table's declared key: rows of ``new`` replace those of the same key."""
    keys = list(RESULT_TABLES[table][1])
    return existing.join(new.select(*keys), keys, "left_anti").select(*existing.columns).unionByName(new.select(*existing.columns))


def check_keys(df: DataFrame, table: str) -> DataFrame:
    """Raises if two rows share the table's declared key."""
    keys = list(RESULT_TABLES[table][1])
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{table}: rows share a key ({', '.join(keys)})")
    return df


def publish_merged(tables: dict[str, DataFrame], target: str, version: int) -> None:
    """Publish the tables merged by key into the version announced last."""
    spark = next(iter(tables.values())).sparkSession
    publish({
        name: merge_keyed(read_published(spark, target, name), check_keys(check_schema(df, name), name), name)
        for name, df in tables.items()
    }, target, version)


def publish(tables: dict[str, DataFrame], target: str, version: int) -> None:
    """Write every table under a new version, then announce it.

    Readers follow the announcement, so they see the whole set or the previous one. Every
    call writes a folder of its own: publishing a version again leaves the files of readers
    that hold it as they are.
    """
    attempt = f"t{uuid.uuid4().hex}"
    for name, df in tables.items():
        out = check_schema(df, name) if name in RESULT_TABLES else df
        out.write.parquet(f"{target}/v={version}/a={attempt}/{name}")
    spark = next(iter(tables.values())).sparkSession
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    mark = one_row(spark, version=F.lit(version).cast("long"), attempt=F.lit(attempt), published_at=F.lit(str(now)).cast("timestamp_ntz"))
    mark.write.mode("append").parquet(f"{target}/{VERSIONS}")


def one_row(spark: SparkSession, **values: Column) -> DataFrame:
    """A row of literals, in one partition and without a Python worker."""
    return spark.range(0, 1, 1, 1).select(*[v.alias(name) for name, v in values.items()])


def announced(spark: SparkSession, target: str) -> DataFrame:
    """(version, attempt) of every announced version, its last attempt."""
    marks = spark.read.schema(_MARK).parquet(f"{target}/{VERSIONS}")
    return marks.groupBy("version").agg(F.max_by("attempt", F.struct("published_at", "attempt")).alias("attempt"))


def published_version(spark: SparkSession, target: str) -> int:
    return spark.read.schema(_MARK).parquet(f"{target}/{VERSIONS}").agg(F.max("version")).first()[0]


def version_path(spark: SparkSession, target: str, version: int) -> str:
    attempt = announced(spark, target).where(F.col("version") == version).first().attempt
    return f"{target}/v={version}/a={attempt}"


def read_published(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{version_path(spark, target, published_version(spark, target))}/{name}")


def compacted_folders(spark: SparkSession, target: str, name: str) -> tuple[int, list[str]]:
    """The version up to which a table is compacted (-1 if it is not), and the folders that hold those rows."""
    try:
        marks = spark.read.parquet(f"{target}/{COMPACTED}/_marks").where(F.col("table") == name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return -1, []
    last = marks.agg(F.max_by(F.struct("version", "folders"), F.struct("version", "at")).alias("r")).first().r
    return (-1, []) if last is None else (last.version, list(last.folders))


def read_all_versions(spark: SparkSession, target: str, name: str) -> DataFrame:
    """The rows of one table in all announced versions together, compacted ones among them."""
    done, folders = compacted_folders(spark, target, name)
    stored = spark.read.option("basePath", target).parquet(f"{target}/v=*/a=*/{name}")
    told = announced(spark, target).where(F.col("version") > done).select(F.col("version").cast("int").alias("v"), F.col("attempt").alias("a"))
    rows = stored.join(told, ["v", "a"], "left_semi").drop("v", "a")
    return rows.unionByName(spark.read.parquet(*folders)) if folders else rows
