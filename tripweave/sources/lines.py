"""A data source for delimited text files: one pass, byte ranges, true offsets.

Files are cut into byte ranges; a range gives the lines that start in it and reads on to the end of
the last one. A file's header is looked for in its first block alone. Every line comes with the
byte it starts at, so its number does not depend on how files are cut or on files added later.
Cells are put in the order of the columns asked for, so headers may differ from file to file.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from glob import glob, has_magic
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of a range at most, of the block that is searched for a header, and lines of a batch.
RANGE_BYTES, HEADER_BYTES, BATCH_LINES = 32 << 20, 64 << 10, 20_000
_END = re.compile(rb"\r\n|\n|\r")
_HIDDEN = ("_", ".")
LINES = (
    "file_no long, offset long, plain boolean, cells array<string>, bad string, line string,"
    "cells2 array<string>, bad2 string, line2 string"
)
HEADERS = "file_no long, cells array<string>"
_STRINGS = pa.list_(pa.string())
_BATCH = pa.schema([
    ("file_no", pa.int64()), ("offset", pa.int64()), ("plain", pa.bool_()), ("cells", _STRINGS), ("bad", pa.string()), ("line", pa.string()),
    ("cells2", _STRINGS), ("bad2", pa.string()), ("line2", pa.string()),
])


def list_files(path: str) -> list[tuple[str, int]]:
    """(place, bytes) of all visible files under a path or pattern, sorted by place."""
    uri = urlparse(path)
    if uri.scheme in ("", "file"):
        local, prefix = unquote(uri.path) if uri.scheme else path, ""
        system = fs.LocalFileSystem()
        roots = sorted(glob(local)) if has_magic(local) else [local]
    else:  # other stores list what lies below the part without a pattern
        system, local = fs.FileSystem.from_uri(path)
        prefix = f"{uri.scheme}://{uri.netloc}" if local.startswith("/") else f"{uri.scheme}://"
        fixed = local.split("/")
        fixed = fixed[: next((i for i, part in enumerate(fixed) if has_magic(part)), len(fixed))]
        roots = ["/".join(fixed)]
    found: dict[str, int] = {}
    for root in roots:
        info = system.get_file_info(root)
        for f in [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True)):
            inside = [] if info.is_file else f.path[len(root):].strip("/").split("/")
            named = not prefix or not has_magic(local) or fnmatch(f.path, local) or fnmatch(f.path, f"{local}/*")
            if f.is_file and f.size and named and not any(part.startswith(_HIDDEN) for part in inside):
                found[prefix + f.path] = f.size
    return sorted(found.items())


def _open(place: str) -> pa.NativeFile:
    if "://" in place:
        system, inner = fs.FileSystem.from_uri(place)
        return system.open_input_file(inner)
    return fs.LocalFileSystem().open_input_file(place)


def cells_of(text: str) -> list[str | None]:
    cells = next(csv.reader([text], skipinitialspace=True)) if '"' in text else text.split(",")
    return [c.strip() or None for c in cells]


def lines_of(f: pa.NativeFile, size: int, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the lines that start from ``begin`` on and before ``end``."""
    base = max(begin - 1, 0)
    f.seek(base)
    data = f.read(end - base)
    while base + len(data) < size and not _END.search(data, max(end - 1 - base, 0)):
        data += f.read(HEADER_BYTES)
    at = 0
    if begin > 0:  # the byte before tells whether a line starts here
        first = _END.search(data)
        at = first.end() if first else len(data)
    while at < len(data) and base + at < end:
        stop = _END.search(data, at)
        yield base + at, data[at : stop.start()] if stop else data[at:]
        at = stop.end() if stop else len(data)


def header_of(f: pa.NativeFile, names: list[str], encodings: list[str]) -> list[str | None] | None:
    """The cells of the first line in the first block that has all of ``names``."""
    f.seek(0)
    for line in _END.split(f.read(HEADER_BYTES)):
        for encoding in encodings:
            try:
                cells = cells_of(line.decode(encoding).removeprefix("﻿"))
            except (UnicodeDecodeError, csv.Error):
                continue
            if set(names) <= set(cells):
                return cells
    return None


@dataclass
class Ranges(InputPartition):
    ranges: list[tuple[int, str, int, int, int]]  # file number, place, size, begin, end


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.names: list[str] = json.loads(options["names"])
        self.columns: list[str] = json.loads(options.get("columns", "[]"))
        self.encodings: list[str] = json.loads(options["encodings"])
        self.headers = options.get("mode") == "headers"
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> list[Ranges]:
        """Ranges of files, small ones together."""
        out: list[Ranges] = []
        room = 0
        for number, (place, size) in enumerate(list_files(self.path)):
            step = size if self.headers else self.range_bytes
            for begin in range(0, size, step):
                end = min(size, begin + step)
                cost = min(HEADER_BYTES, size) if self.headers else end - begin
                if not out or cost > room:
                    out.append(Ranges([]))
                    room = self.range_bytes
                out[-1].ranges.append((number, place, size, begin, end))
                room -= cost
        return out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for number, place, size, begin, end in partition.ranges:
            with _open(place) as f:
                header = header_of(f, self.names, self.encodings)
                if self.headers:
                    yield pa.RecordBatch.from_pydict(
                        {"file_no": [number], "cells": [header]}, schema=pa.schema([("file_no", pa.int64()), ("cells", _STRINGS)])
                    )
                else:
                    yield from self._batches(number, header, lines_of(f, size, begin, end))

    def _batches(self, number: int, header: list | None, lines: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        take = [header.index(c) if header and c in header else None for c in self.columns]
        width = len(header) if header else 0
        hint = self.names[0].encode()
        rows: list[tuple] = []
        for offset, line in lines:
            if not line:
                continue
            plain = line.isascii()
            readings = [self._reading(line, e, offset, header, width, take, hint) for e in self.encodings[: 1 if plain else 2]]
            if any(r is None for r in readings):
                continue  # a header
            rows.append((number, offset, plain, *readings[0], *(readings[1] if len(readings) > 1 else (None, None, None))))
            if len(rows) >= BATCH_LINES:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _reading(self, line: bytes, encoding: str, offset: int, header: list | None, width: int, take: list, hint: bytes) -> tuple | None:
        """(cells, reason, text) of a line in one encoding; text only with a reason. None for a header."""
        try:
            text = line.decode(encoding)
        except UnicodeDecodeError:
            return None, "bad_encoding", line.hex().upper()
        text = text.removeprefix("﻿") if offset == 0 else text
        try:
            cells = cells_of(text)
        except csv.Error:
            return None, "corrupt_line" if header else "no_header", text
        if hint in line and set(self.names) <= set(cells):
            return None
        if header is None:
            return None, "no_header", text
        if len(cells) != width:
            return [cells[i] if i is not None and i < len(cells) else None for i in take], "corrupt_line", text
        return [cells[i] if i is not None else None for i in take], None, None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _BATCH, strict=True)], schema=_BATCH)


class LineSource(DataSource):
    """``delimited_lines``: options path, names, columns, encodings (JSON lists), rangeBytes, mode (headers or lines)."""

    @classmethod
    def name(cls) -> str:
        return "delimited_lines"

    def schema(self) -> str:
        return HEADERS if self.options.get("mode") == "headers" else LINES

    def reader(self, schema: StructType) -> LineReader:
        return LineReader(dict(self.options))
