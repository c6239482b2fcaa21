"""Session helpers: a local builder for tests and benches, and shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent

_SHIPPED = "vantle.shipped"


def local_session(cpus: int = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local[cpus] session with adaptive execution and UTC time."""
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([str(PACKAGE.parent), *os.environ.get("PYTHONPATH", "").split(os.pathsep)])).rstrip(os.pathsep)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vantle")
        .config("spark.driver.memory", conf.pop("driver_memory", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package, once per application.

    Workers import functions by name, so the package must be importable there;
    the driver's ``sys.path`` is not passed on by Spark.
    """
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    folder = tempfile.mkdtemp(prefix="vantle-")
    path = os.path.join(folder, "vantle_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, Path("vantle") / file.relative_to(PACKAGE))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    The cluster names it in spark.checkpoint.dir. Only a local session, as in tests, may
    leave it unset: then a folder below the warehouse serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_vantle"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Folders that this process has written and not dropped.
_WRITTEN: list[str] = []

#: How ``written`` stores tables on a local or mounted disk: without a checksum file beside each file.
#: Hadoop starts a process (chmod) for every file it creates there, and a JVM that is starting one can
#: be counted twice by who adds up an executor's memory. Parquet keeps checksums of its pages.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def drop_written(spark: SparkSession) -> int:
    """Delete the tables that ``written`` has stored so far; how many. Frames that read them end with it."""
    hadoop = spark._jsc.hadoopConfiguration()
    n = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(hadoop).delete(path, True)
    return n


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there.

    The tables stay until ``drop_written`` or the folder's owner deletes them.
    """
    path = shared_folder(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.options(**PLAIN_FILES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
