"""Structured Streaming forms: exactly-once file pickup, keyed lags, running statistics, stream joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.normalize import parse_time


def feed_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.csv", files_per_trigger: int | None = None) -> DataFrame:
    """New CSV files of a folder, each picked up once per checkpoint, with their source path."""
    reader = spark.readStream.format("csv").option("header", True).option("pathGlobFilter", glob).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # where a row comes from: by these, the last of a batch is the last of the newest file
    arrival = F.struct(F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"))
    return reader.load(folder).select("*", F.input_file_name().alias("source_file"), arrival.alias("arrival"))


def append_available(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet table and end; the checkpoint keeps pickup exactly once."""
    return stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def upsert_available(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], partition: str) -> StreamingQuery:
    """Merge what has arrived by key, late files included: only touched partitions are rewritten.

    The last value of a key by arrival wins: that of the latest batch and there, for a stream
    of feed_stream, of the newest file and its last row. A batch that is run again gives the
    same table.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        arrival = F.col("arrival") if "arrival" in batch.columns else F.lit(0)
        new = batch.withColumn("__at", F.struct(F.lit(number).alias("batch"), arrival.alias("arrival"), F.monotonically_increasing_id().alias("row"))).drop("arrival")
        try:
            old = spark.read.parquet(table)
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem) and "UNABLE_TO_INFER_SCHEMA" not in str(problem):
                raise
            old = None
        if old is not None:
            new = old.join(new.select(partition).distinct(), partition, "left_semi").unionByName(new)
        rest = [c for c in new.columns if c not in keys]
        merged = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("__at")).alias("r")).select(*keys, "r.*")
        # staged first: a partition that is being overwritten is never read by the same job
        staging = f"{table.rstrip('/')}_staged"
        merged.write.mode("overwrite").parquet(staging)
        spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class LastValues(StatefulProcessor):
    """Keeps the last N values of each feature for a key and emits them with every row."""

    def __init__(self, order: str, features: Sequence[str], lags: int, columns: Sequence[str], ttl_ms: int | None = None):
        self.order, self.features, self.lags, self.columns, self.ttl_ms = order, list(features), lags, list(columns), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = T.StructType([T.StructField(f, T.DoubleType()) for f in self.features])
        self.past = handle.getListState("past", kind, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        past = list(self.past.get()) if self.past.exists() else []
        out = {f"{f}_past_{k}": [] for f in self.features for k in range(1, self.lags + 1)}
        for values in frame[self.features].itertuples(index=False, name=None):
            for i, f in enumerate(self.features):
                for k in range(1, self.lags + 1):
                    out[f"{f}_past_{k}"].append(past[-k][i] if k <= len(past) else None)
            past = [*past, tuple(None if pd.isna(v) else float(v) for v in values)][-self.lags :]
        self.past.put(past)
        yield frame[self.columns].assign(**{n: pd.array(v, dtype="Float64").to_numpy(dtype=float, na_value=float("nan")) for n, v in out.items()})

    def close(self) -> None:
        pass


def stream_lags(stream: DataFrame, key: str, order: str, features: Sequence[str], lags: int, ttl_ms: int | None = None) -> DataFrame:
    """Lags of a stream per key in arrival batches, ordered by ``order`` within a batch; needs the RocksDB state store."""
    schema = T.StructType([*stream.schema.fields, *[T.StructField(f"{f}_past_{k}", T.DoubleType()) for f in features for k in range(1, lags + 1)]])
    processor = LastValues(order, features, lags, stream.columns, ttl_ms)
    return stream.groupBy(key).transformWithStateInPandas(processor, outputStructType=schema, outputMode="Append", timeMode="None" if ttl_ms is None else "ProcessingTime")


def running_statistics(stream: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, mean, population variance, least and largest value of each column, kept up to date (complete mode).

    Spark's variance merges central moments, so large values don't cancel as squares would.
    """
    value = lambda c: F.col(c).cast("double")
    parts = [f(value(c)).alias(f"{n}_{c}") for c in columns for n, f in (("n", F.count), ("mean", F.avg), ("variance", F.var_pop), ("min", F.min), ("max", F.max))]
    return stream.groupBy().agg(*parts)


def running_values(stream: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): the distinct values of each column as trimmed text, empty ones as ``nan``, and how often each came.

    Its rows a column are the exact running distinct count; the state holds each value once.
    """
    text = lambda c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("nan"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns])).alias("x")
    return stream.select(each).groupBy("x.column", "x.value").agg(F.count("*").alias("n")).select("column", "value", "n")


def stream_join(left: DataFrame, right: DataFrame, key: str, time: str, delay: str = "2 hours") -> DataFrame:
    """Full outer join of two streams on key and time; watermarks bound how long a row waits for its partner."""
    a = left.withWatermark(time, delay).alias("a")
    b = right.withWatermark(time, delay).alias("b")
    on = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col(f"a.{time}") == F.col(f"b.{time}"))
    joined = a.join(b, on, "full_outer")
    rest = [F.col(f"a.{c}") for c in left.columns if c not in (key, time)] + [F.col(f"b.{c}") for c in right.columns if c not in (key, time) and c not in left.columns]
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.coalesce(f"a.{time}", f"b.{time}").alias(time), *rest)


def with_event_time(stream: DataFrame, time: str, name: str = "event_time") -> DataFrame:
    """The parsed time as a timestamp that watermarks accept."""
    return stream.withColumn(name, parse_time(time).cast("timestamp"))
