"""Shapefiles as a Spark data source, and a writer, by the public ESRI layout.

``spark.read.format("shapes").load(path)`` gives one row a record: attributes as text
and ``parts`` as arrays of (x, y). A file's records are cut in ranges by the .shx index,
so large files are read by several tasks; paths must be readable by the executors.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

PARTS = "array<array<struct<x:double,y:double>>>"
#: Shape types of the format, without and with further coordinates.
POINTS, LINES, POLYGONS, CLOUDS = {1, 11, 21}, {3, 13, 23}, {5, 15, 25}, {8, 18, 28}


def _base(path: str) -> str:
    return os.path.splitext(path)[0]


def dbf_fields(path: str) -> tuple[list[tuple[str, int]], int, int, int]:
    """(name, width) of each field, header size, record size, records."""
    with open(path, "rb") as file:
        n, head, size = struct.unpack("<4xIHH", file.read(12))
        file.seek(32)
        raw = file.read(head - 32)
    fields = []
    for i in range(0, len(raw) - 31, 32):
        if raw[i] == 0x0D:
            break
        fields.append((raw[i : i + 11].split(b"\0")[0].decode("latin-1"), raw[i + 16]))
    return fields, head, size, n


def shape_parts(record: bytes) -> list[list[tuple[float, float]]]:
    """Parts of one record's content; empty for a null shape."""
    kind = struct.unpack_from("<i", record)[0]
    if kind in POINTS:
        return [[struct.unpack_from("<2d", record, 4)]]
    if kind in CLOUDS:
        n = struct.unpack_from("<i", record, 36)[0]
        return [[struct.unpack_from("<2d", record, 40 + 16 * k)] for k in range(n)]
    if kind in LINES or kind in POLYGONS:
        n_parts, n = struct.unpack_from("<2i", record, 36)
        starts = [*struct.unpack_from(f"<{n_parts}i", record, 44), n]
        xy = struct.unpack_from(f"<{2 * n}d", record, 44 + 4 * n_parts)
        return [[(xy[2 * k], xy[2 * k + 1]) for k in range(a, b)] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return []


class Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class ShapesReader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows

    def partitions(self) -> Sequence[Range]:
        n = (os.path.getsize(_base(self.path) + ".shx") - 100) // 8
        return [Range(i, min(n, i + self.rows)) for i in range(0, n, self.rows)] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        base = _base(self.path)
        fields, head, size, _ = dbf_fields(base + ".dbf") if os.path.exists(base + ".dbf") else ([], 0, 0, 0)
        with open(base + ".shx", "rb") as index:
            index.seek(100 + 8 * partition.first)
            spots = struct.iter_unpack(">2i", index.read(8 * (partition.last - partition.first)))
            with open(base + ".shp", "rb") as shapes:
                table = open(base + ".dbf", "rb") if fields else None
                for k, (offset, length) in enumerate(spots, partition.first):
                    shapes.seek(2 * offset + 8)
                    parts = shape_parts(shapes.read(2 * length))
                    values = []
                    if table:
                        table.seek(head + k * size + 1)
                        row, at = table.read(size - 1), 0
                        for _, width in fields:
                            values.append(row[at : at + width].decode("utf-8", "replace").strip() or None)
                            at += width
                    yield (k, *values, parts)
                if table:
                    table.close()


class Shapes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapes"

    def schema(self) -> str:
        dbf = _base(self.options["path"]) + ".dbf"
        fields = dbf_fields(dbf)[0] if os.path.exists(dbf) else []
        return ", ".join(["record long", *(f"`{n}` string" for n, _ in fields), f"parts {PARTS}"])

    def reader(self, schema: StructType) -> ShapesReader:
        return ShapesReader(self.options["path"], int(self.options.get("rows", "20000")))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Shapes)


def write_shapes(path: str, kind: int, rows: Sequence[tuple[dict[str, str], list[list[tuple[float, float]]]]]) -> None:
    """A small shapefile (kind 1, 3 or 5) with text attributes: .shp, .shx and .dbf."""
    base = _base(path)
    names = list(dict.fromkeys(n for a, _ in rows for n in a))
    width = {n: max([1, *(len(str(a.get(n, "")).encode()) for a, _ in rows)]) for n in names}
    body, index = b"", b""
    xs = [x for _, parts in rows for p in parts for x, _ in p] or [0.0]
    ys = [y for _, parts in rows for p in parts for _, y in p] or [0.0]
    for k, (_, parts) in enumerate(rows):
        points = [q for p in parts for q in p]
        if not points:
            content = struct.pack("<i", 0)
        elif kind == 1:
            content = struct.pack("<i2d", 1, *points[0])
        else:
            starts, at = [], 0
            for p in parts:
                starts.append(at)
                at += len(p)
            px, py = [q[0] for q in points], [q[1] for q in points]
            content = struct.pack("<i4d2i", kind, min(px), min(py), max(px), max(py), len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<2d", *q) for q in points)
        index += struct.pack(">2i", (100 + len(body)) // 2, len(content) // 2)
        body += struct.pack(">2i", k + 1, len(content) // 2) + content
    for suffix, data in ((".shp", body), (".shx", index)):
        head = struct.pack(">i20xi", 9994, (100 + len(data)) // 2) + struct.pack("<2i4d4d", 1000, kind, min(xs), min(ys), max(xs), max(ys), 0, 0, 0, 0)
        with open(base + suffix, "wb") as file:
            file.write(head + data)
    size = 1 + sum(width.values())
    with open(base + ".dbf", "wb") as file:
        file.write(struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), 32 + 32 * len(names) + 1, size))
        for n in names:
            file.write(struct.pack("<11sc4xBB14x", n.encode()[:10], b"C", width[n], 0))
        file.write(b"\r")
        for a, _ in rows:
            file.write(b" " + b"".join(str(a.get(n, "")).encode().ljust(width[n]) for n in names))
        file.write(b"\x1a")
