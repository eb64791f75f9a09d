"""The line source: ranges, offsets, headers and encodings."""

from __future__ import annotations

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from tripweave.sources import files, lines

HEAD = "VehicleNum,Stime,Lng,Lat,OpenStatus,Speed"


def test_ranges_give_every_line_once_with_its_offset():
    rnd = random.Random(3)
    for _ in range(60):
        data = b"".join(rnd.choice([b"a", b"bb,", b"", b"xyz"]) + rnd.choice([b"\n", b"\r\n", b"\r", b"\n\n", b"q"]) for _ in range(rnd.randint(0, 30)))
        want, at = [], 0
        for m in re.finditer(rb"\r\n|\n|\r", data):
            want.append((at, data[at:m.start()]))
            at = m.end()
        want += [(at, data[at:])] if at < len(data) else []
        for step in (1, 2, 3, 7, 1000):
            got = []
            for begin in range(0, len(data), step):
                got += lines.lines_of(pa.BufferReader(data), len(data), begin, min(len(data), begin + step))
            assert got == want, (data, step)


def _table(spark, path, encoding="UTF-8"):
    return files.read_text_table(spark, str(path), files.PING_NAMES, encoding)


def test_row_numbers_stay_for_any_split_and_after_later_files(spark, tmp_path):
    rows = [f"{i},00:00:00,114.1,22.7,{i % 2},{'9' * (i % 5)}" for i in range(2000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([HEAD, *rows[:1200]]) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\r\n".join([HEAD, *rows[1200:]]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    numbers = lambda: {r.VehicleNum: r.seq for r in _table(spark, tmp_path / "in").select("VehicleNum", "seq").collect()}
    want = numbers()
    assert len(want) == len(set(want.values())) == 2000 and sorted(want, key=want.get) == [str(i) for i in range(2000)]
    try:
        for size in ("9000", "777"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert numbers() == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "in" / "c.csv").write_text(f"{HEAD}\n9999,00:00:00,114.1,22.7,1,1\n")
    after = numbers()
    assert {k: after[k] for k in want} == want and len(after) == 2001


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = lambda i, note: f"{i},07:00:00,114.1,22.7,1,3,{note}"
    write = lambda name, rows, encoding: (tmp_path / "in" / name).write_bytes("\n".join([HEAD + ",备注", *rows]).encode(encoding) + b"\n")
    write("a.csv", [line(1, "出租车"), line(2, "plain")], "utf-8")
    write("b.csv", [line(3, "出租车"), line(4, "é")], "gb18030")
    write("c.csv", [line(5, "出租车"), line(6, "车")], "utf-8-sig")
    with open(tmp_path / "in" / "c.csv", "ab") as f:
        f.write(line(7, "").encode() + b"\xff\xff\n")
    raw = _table(spark, tmp_path / "in", "auto").orderBy("seq").collect()
    assert [(r.VehicleNum, r["备注"], r._bad) for r in raw] == [
        ("1", "出租车", None), ("2", "plain", None), ("3", "出租车", None), ("4", "é", None), ("5", "出租车", None), ("6", "车", None),
        (None, None, "bad_encoding"),
    ]


def test_any_number_of_headers(spark, tmp_path):
    names = HEAD.split(",")
    for i in range(130):
        order = names[i % 6:] + names[:i % 6] + [f"extra{i}"]
        cells = {"VehicleNum": str(i), "Stime": "07:00:00", "Lng": "114.1", "Lat": "22.7", "OpenStatus": "1", "Speed": "3", f"extra{i}": f'"e, {i}"'}
        (tmp_path / f"{i:03}.csv").write_text(",".join(order) + "\n" + ",".join(cells[c] for c in order) + "\n")
    raw = _table(spark, tmp_path)
    assert len(raw.columns) == 6 + 130 + 3
    got = raw.select("VehicleNum", "Lng", F.coalesce(*[F.col(f"extra{i}") for i in range(130)]).alias("e")).orderBy("seq").collect()
    assert [tuple(r) for r in got] == [(str(i), "114.1", f"e, {i}") for i in range(130)]
    assert raw.where("_bad IS NOT NULL").count() == 0


def test_no_files_and_files_without_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"")
    (tmp_path / "in" / "b.csv").write_text(HEAD + "\n\n\n")
    (tmp_path / "in" / "_hidden.csv").write_text(HEAD + "\n1,07:00:00,114.1,22.7,1,3\n")
    assert _table(spark, tmp_path / "in").count() == 0 == _table(spark, tmp_path / "in", "auto").count()
