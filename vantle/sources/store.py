"""Small files in whatever store the session's paths name: by Hadoop's file systems, never by open().

A file is written beside its place and renamed over it, so readers see the old or the new one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path) of the Java side."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's readers report it."""
    files, place = _at(spark, path)
    return files.makeQualified(place).toString()


def listing(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files right in a folder, by name."""
    files, place = _at(spark, folder)
    found = [(s.getPath().toString(), s.getLen()) for s in files.listStatus(place) if s.isFile()]
    return sorted(found)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Replace a file, its folder made first."""
    files, place = _at(spark, path)
    files.mkdirs(place.getParent())
    part = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex[:8]}")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    over[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(part), files.makeQualified(place), over)


def read_json(spark: SparkSession, path: str) -> object:
    return json.loads(read_bytes(spark, path).decode())


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_bytes(spark, path, json.dumps(value, indent=2, default=str).encode())
