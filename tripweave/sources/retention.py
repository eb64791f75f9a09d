"""Retention of versioned stores: what no reader can reach any more is removed.

Kept are the versions announced last, versions under a lease, the last attempt of each, and folders that
kept versions name. Tables that are read over all versions (settled trips) are compacted first: their
rows move to folders of their own, which are merged once there are several. So the number of files
follows the versions kept and not the batches so far.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.sources.sinks import COMPACTED, VERSIONS, announced, compacted_folders

_LEASES = "_leases"
#: Compacted folders of a table that are merged into one.
MERGE_AT = 4
#: Bytes of a compacted file, about.
FILE_BYTES = 256 << 20


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _system(spark: SparkSession, path: str):  # noqa: ANN202
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(spark: SparkSession, path: str) -> list[str]:
    system, place = _system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def _remove(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def _bytes(spark: SparkSession, path: str) -> int:
    system, place = _system(spark, path)
    return system.getContentSummary(place).getLength()


def lease(spark: SparkSession, target: str, version: int, seconds: int) -> str:
    """Keeps a version for a reader; the lease's name, for :func:`release`."""
    name = f"l{uuid.uuid4().hex}"
    row = spark.createDataFrame([(version, _now(), _now() + timedelta(seconds=seconds))], "version long, since timestamp_ntz, until timestamp_ntz")
    row.coalesce(1).write.parquet(f"{target}/{_LEASES}/{name}")
    return name


def release(spark: SparkSession, target: str, name: str) -> None:
    _remove(spark, f"{target}/{_LEASES}/{name}")


def _leases(spark: SparkSession, target: str) -> list[tuple[int, datetime]]:
    """(version, since) of the leases that hold; those that are over go."""
    held = []
    for name in _children(spark, f"{target}/{_LEASES}"):  # a row for each reader
        row = spark.read.parquet(f"{target}/{_LEASES}/{name}").first()
        if row.until < _now():
            release(spark, target, name)
        else:
            held.append((row.version, row.since))
    return held


def _drop_merged(spark: SparkSession, target: str, table: str, since: list[datetime]) -> None:
    """Removes compacted folders that were merged into others, but for those that a lease may have found."""
    _, current = compacted_folders(spark, target, table)
    home = f"{target}/{COMPACTED}/{table}"
    for name in _children(spark, home):
        system, place = _system(spark, f"{home}/{name}")
        made = datetime.fromtimestamp(system.getFileStatus(place).getModificationTime() / 1000, timezone.utc).replace(tzinfo=None)
        if f"{home}/{name}" not in current and not any(made <= s for s in since):
            _remove(spark, f"{home}/{name}")


def _compact(spark: SparkSession, target: str, table: str, attempts: dict[int, str], upto: int) -> None:
    """Moves the rows of versions up to ``upto`` to a compacted folder, or all of them to one."""
    done, folders = compacted_folders(spark, target, table)
    new = [v for v in sorted(attempts) if done < v <= upto]
    if not new:
        return
    parts = [f"{target}/v={v}/a={attempts[v]}/{table}" for v in new]
    merge = len(folders) + 1 >= MERGE_AT
    out = f"{target}/{COMPACTED}/{table}/c{uuid.uuid4().hex}"
    sources = [*parts, *(folders if merge else [])]
    files = max(1, -(-sum(_bytes(spark, x) for x in sources) // FILE_BYTES))
    spark.read.parquet(*sources).coalesce(files).write.parquet(out)
    kept = [out] if merge else [*folders, out]
    mark = spark.createDataFrame([(table, upto, kept, _now())], "table string, version long, folders array<string>, at timestamp_ntz")
    mark.coalesce(1).write.mode("append").parquet(f"{target}/{COMPACTED}/_marks")


def _rewrite(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """A small table anew: its new files first, then the old ones go, so readers always find its rows."""
    old = [c for c in _children(spark, path)]
    values = spark.createDataFrame(rows.collect(), rows.schema)  # a row for each kept version
    values.coalesce(1).write.mode("append").parquet(path)
    for name in old:
        if not name.startswith("_SUCCESS"):
            _remove(spark, f"{path}/{name}")


def retain(
    spark: SparkSession, target: str, keep: int = 2, all_versions: tuple[str, ...] = (), references: dict[str, str] | None = None
) -> list[int]:
    """Removes what neither the last ``keep`` versions nor a lease reaches; the versions that stay.

    ``all_versions`` names tables that are read over all versions. ``references`` maps a table to its
    column of folders that kept versions still read (as the regions of growing clusters do). Call
    it from the writer, between two versions: folders of versions not announced yet are left alone.
    """
    attempts = {r.version: r.attempt for r in announced(spark, target).collect()}  # versions since the last call
    last = max(attempts)
    leases = _leases(spark, target)
    live = {v for v in attempts if v > last - keep or v in {held for held, _ in leases}}
    for table in all_versions:
        _compact(spark, target, table, attempts, last - keep)
        _drop_merged(spark, target, table, [since for _, since in leases])
    folders = {f"v={v}/a={attempts[v]}" for v in live}
    for table, column in (references or {}).items():
        for v in sorted(live):
            named = spark.read.parquet(f"{target}/v={v}/a={attempts[v]}/{table}").select(column).distinct().collect()  # bounded by the area
            folders |= {"/".join(r[0].removeprefix(f"{target}/").split("/")[:2]) for r in named}
    for version in _children(spark, target):
        if not version.startswith("v=") or int(version[2:]) > last:
            continue
        inside = _children(spark, f"{target}/{version}")
        stay = [a for a in inside if f"{version}/{a}" in folders]
        for attempt in inside if stay else []:
            if attempt not in stay:
                _remove(spark, f"{target}/{version}/{attempt}")
        if not stay:
            _remove(spark, f"{target}/{version}")
    marks = spark.read.parquet(f"{target}/{VERSIONS}")
    _rewrite(spark, f"{target}/{VERSIONS}", marks.where(F.col("version").isin(sorted(live))))
    if _children(spark, f"{target}/{COMPACTED}/_marks"):
        told = spark.read.parquet(f"{target}/{COMPACTED}/_marks")
        latest = told.groupBy("table").agg(F.max_by(F.struct(*told.columns), F.struct("version", "at")).alias("r")).select("r.*")
        _rewrite(spark, f"{target}/{COMPACTED}/_marks", latest)
    return sorted(live)
