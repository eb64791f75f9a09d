"""Versions, leases and compaction: files stay bounded and every reader keeps its rows."""

from __future__ import annotations

import os

from tripweave.sources import retention, sinks


def _files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_files_stay_bounded_while_a_reader_holds_a_version(spark, tmp_path):
    target, counts, held = str(tmp_path / "s"), [], None
    table = lambda lo, hi: spark.range(lo, hi, 1, 1).select("id")
    for v in range(25):
        for _ in range(2 if v % 6 == 1 else 1):  # some versions are written again
            sinks.publish({"trips": table(10 * v, 10 * v + 3), "kept": table(v, v + 1)}, target, v)
        if v == 4:
            held = retention.lease(spark, target, 4, 3600)
            old = sinks.version_path(spark, target, 4)
        if v % 4 == 3 or v > 20:
            live = retention.retain(spark, target, keep=2, all_versions=("trips",))
            assert live == sorted({v - 1, v} | ({4} if v > 4 else set()))
            counts.append(_files(target))
            assert sinks.published_version(spark, target) == v
            assert [r.id for r in sinks.read_published(spark, target, "kept").collect()] == [v]
            rows = [r.id for r in sinks.read_all_versions(spark, target, "trips").collect()]
            assert sorted(rows) == [10 * i + k for i in range(v + 1) for k in range(3)]
    assert [r.id for r in spark.read.parquet(f"{old}/kept").collect()] == [4]
    assert max(counts[2:]) <= 20 and counts[-1] <= counts[3] + 4
    retention.release(spark, target, held)
    assert retention.retain(spark, target, keep=1, all_versions=("trips",)) == [24] and not os.path.exists(old)
    assert sinks.read_all_versions(spark, target, "trips").count() == 75


def test_named_folders_stay_and_leases_end(spark, tmp_path):
    target = str(tmp_path / "s")
    for v in range(4):
        sinks.publish({"sites": spark.range(v, v + 1)}, target, v)
        first = sinks.version_path(spark, target, 0)
        sinks.publish({"sites": spark.range(v, v + 1), "regions": spark.createDataFrame([(f"{first}/sites",)], "path string")}, target, v) if v else None
    retention.lease(spark, target, 1, -1)
    assert retention.retain(spark, target, keep=1, references={"regions": "path"}) == [3]
    assert sorted(os.listdir(target)) == ["_leases", "_versions", "v=0", "v=3"] and not os.listdir(f"{target}/_leases")
    assert spark.read.parquet(f"{first}/sites").count() == 1
