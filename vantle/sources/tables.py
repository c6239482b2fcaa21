"""CSV, JSON and array tables: reading with declared types, writing with chosen missing marks."""

from __future__ import annotations

import csv
import io
import json
import os
import pickle
import struct
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

#: Declared types of known columns; every other column of a CSV is read as text.
KNOWN = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("zip", "time", "city", "state", "trifd", "facility", "chemical")]
    + [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude", "us_aqi", "pm2_5", "ozone", "wind_speed_10m", "wind_speed_100m", "wind_direction_10m", "wind_direction_100m", "total_air_emissions_lbs")]
)


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a CSV; an empty file raises."""
    names = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path).columns
    if not names:
        raise ValueError(f"empty file: {path}")
    return names


def csv_schema(names: Sequence[str], known: T.StructType = KNOWN) -> T.StructType:
    types = {f.name: f.dataType for f in known}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


def text_schema(names: Sequence[str]) -> T.StructType:
    """Every column as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | None = None, text_only: bool = False) -> DataFrame:
    """A CSV with a header. Short rows are filled with NULL, extra fields dropped; types are declared, never guessed."""
    names = header(spark, path, sep)
    schema = schema or (text_schema(names) if text_only else csv_schema(names))
    return spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("enforceSchema", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, missing: str = "", single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header in fixed column order; NULL as ``missing``, NaN as ``nan``."""
    out = df.select(*columns) if columns else df
    floats = [f.name for f in out.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    out = out.withColumns({c: F.when(F.isnan(c), "nan").otherwise(F.col(c).cast("string")) for c in floats}) if floats else out
    (out.coalesce(1) if single_file else out).write.mode(mode).option("header", True).option("nullValue", missing).option("emptyValue", "").csv(path)


def remove_fields(spark: SparkSession, path: str, output: str, columns: Sequence[str], sep: str = ",") -> None:
    """A CSV without the first column of each given name, written as a folder of CSV parts with a header.

    Works on fields, not on typed columns: of repeated names only the first goes, short rows
    are filled to the header's width, and fields beyond it stay. Absent names raise. A quoted
    field may not hold a line break.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    first = lines.orderBy("split", "at").first()
    if first is None or not first["value"].strip():
        raise ValueError(f"empty file: {path}")
    names = next(csv.reader([first["value"]], delimiter=sep))
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    gone = {names.index(c) for c in columns}

    def cut(rows: list[list[str]]) -> list[str]:
        out = io.StringIO()
        csv.writer(out, delimiter=sep, lineterminator="\n").writerows([v for i, v in enumerate([*r, *[""] * (len(names) - len(r))]) if i not in gone] for r in rows)
        return out.getvalue().splitlines()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            got = cut(list(csv.reader(batch.column(0).to_pylist(), delimiter=sep)))
            yield pa.RecordBatch.from_pydict({"value": pa.array(([] if begun else cut([names])) + got, pa.string())})
            begun = True

    rows = lines.filter(~((F.col("split") == first["split"]) & (F.col("at") == first["at"]))).filter("value <> ''").select("value")
    rows.mapInArrow(run, "value string").write.mode("overwrite").text(output)


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows one after another; tables without columns are left out; other headers must agree exactly."""
    full = [t for t in tables if t.columns]
    if not full:
        raise ValueError("no table with columns")
    for t in full[1:]:
        if t.columns != full[0].columns:
            raise ValueError(f"header {t.columns} differs from {full[0].columns}")
    out = full[0]
    for t in full[1:]:
        out = out.union(t)
    return out


def read_json(path: str) -> object:
    """A small JSON document; a Python-style ``name = {...}`` assignment is read too."""
    with open(path, encoding="utf-8") as file:
        return parse_json(file.read())


def parse_json(text: str) -> object:
    """JSON text, or a Python-style assignment of it."""
    start = text.find("{")
    if start > 0 and "=" in text[:start]:
        text = text[start:].rstrip().rstrip(";")
    return json.loads(text)


def write_json(path: str, value: object) -> None:
    """A small JSON document, its folder made first."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        json.dump(value, file, indent=2, default=str)


def write_mapping(path: str, name: str, mapping: dict) -> None:
    """A file of mapping_text."""
    with open(path, "w", encoding="utf-8") as file:
        file.write(mapping_text(name, mapping))


def mapping_text(name: str, mapping: dict) -> str:
    """``name = {...}`` as source text."""
    return f"{name} = {json.dumps(mapping, indent=4, sort_keys=True)}\n"


def coordinate_map(spark: SparkSession, mapping: dict[str, dict[str, float]]) -> DataFrame:
    """(zip, latitude, longitude) of a place map, which is an input and no constant."""
    return spark.createDataFrame([(k, float(v["latitude"]), float(v["longitude"])) for k, v in sorted(mapping.items())], "zip string, latitude double, longitude double")


def first_coordinates(df: DataFrame, key: str, lat: str, lon: str, order: Sequence[str]) -> DataFrame:
    """(zip, latitude, longitude): the first usable coordinates of each place by ``order``."""
    from ..functions.normalize import number, zip_digits
    from ..operators.stats import first_per_key

    rows = df.select(zip_digits(key).alias("zip"), number(F.col(lat).cast("string")).alias("latitude"), number(F.col(lon).cast("string")).alias("longitude"), *order)
    rows = rows.filter("zip is not null").dropna(subset=["latitude", "longitude"])
    return first_per_key(rows, ["zip"], order).drop(*order)


def export_npy(cells: DataFrame, path: str, dims: Sequence[int], index: Sequence[str], value: str = "value") -> None:
    """Cells as one dense float32 array file. The array must fit the driver: an export for single-machine training."""
    out = np.full(tuple(dims), np.nan, np.float32)
    for row in cells.select(*index, value).toLocalIterator():
        out[tuple(row[i] for i in index)] = row[value]
    content = io.BytesIO()
    np.save(content, out)
    store.write_bytes(cells.sparkSession, path, content.getvalue())


def import_npy(spark: SparkSession, path: str, index: Sequence[str]) -> DataFrame:
    """The cells of an array file that are no NaN."""
    array = np.load(io.BytesIO(store.read_bytes(spark, path)))
    at = np.argwhere(~np.isnan(array))
    rows = [(*map(int, i), float(array[tuple(i)])) for i in at]
    return spark.createDataFrame(rows, ", ".join(f"{n} int" for n in index) + ", value float")


def export_tensor_file(spark: SparkSession, npy: str, path: str) -> None:
    """A .pt file of an array file, by the public layout that ``torch.load`` reads; torch itself isn't needed.

    An uncompressed zip of the raw little-endian storage, a version, a byte order, and a
    pickle that rebuilds the tensor from the storage, its sizes and its strides.
    """
    array = np.ascontiguousarray(np.load(io.BytesIO(store.read_bytes(spark, npy))), "<f4")
    number = lambda n: b"J" + struct.pack("<i", n) if n < 1 << 31 else b"\x8a\x08" + struct.pack("<q", n)
    text = lambda t: b"X" + struct.pack("<I", len(t)) + t.encode()
    numbers = lambda values: b"(" + b"".join(map(number, values)) + b"t"
    storage = b"(" + text("storage") + b"ctorch\nFloatStorage\n" + text("0") + text("cpu") + number(array.size) + b"tQ"
    arguments = storage + number(0) + numbers(array.shape) + numbers(s // 4 for s in array.strides) + b"\x89" + b"ccollections\nOrderedDict\n)R"
    pickled = b"\x80\x02ctorch._utils\n_rebuild_tensor_v2\n(" + arguments + b"tR."
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_STORED) as archive:
        for name, data in (("data.pkl", pickled), ("byteorder", b"little"), ("data/0", array.tobytes()), ("version", b"3\n")):
            archive.writestr(f"tensor/{name}", data)
    store.write_bytes(spark, path, content.getvalue())


class _TensorPickle(pickle.Unpickler):
    """Reads the pickle of a .pt file as (storage key, sizes, strides), and no other class."""

    def find_class(self, module: str, name: str) -> object:
        known = {
            ("torch._utils", "_rebuild_tensor_v2"): lambda stored, offset, sizes, strides, *rest: (stored, offset, sizes, strides),
            ("torch", "FloatStorage"): "<f4",
            ("collections", "OrderedDict"): dict,
        }
        return known[module, name]

    def persistent_load(self, pid: tuple) -> tuple:
        return pid


def import_tensor_file(spark: SparkSession, path: str) -> np.ndarray:
    """The array of a .pt file with one float32 tensor."""
    with zipfile.ZipFile(io.BytesIO(store.read_bytes(spark, path))) as archive:
        (inside,) = [n for n in archive.namelist() if n.endswith("/data.pkl")]
        stored, offset, sizes, strides = _TensorPickle(io.BytesIO(archive.read(inside))).load()
        flat = np.frombuffer(archive.read(f"{inside[:-8]}data/{stored[2]}"), stored[1])
    return np.lib.stride_tricks.as_strided(flat[offset:], sizes, [4 * s for s in strides]).copy()
