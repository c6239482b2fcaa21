"""Lagged features: one window specification for all features and lags of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import number
from ..session import written
from .project import require


def add_lags(df: DataFrame, key: str, order: Sequence[str | Column], features: Sequence[str], lags: int, missing: object = None, numeric: bool = True, strict: bool = True) -> DataFrame:
    """``<feature>_past_<k>`` for k = 1 .. lags: the k-th previous row of the key by ``order``.

    Rows count, not hours: a gap in time doesn't count. missing stands before the first
    row and, for numeric lags, for missing values too. An unknown feature raises if
    ``strict``, else its lags are all ``missing``.
    """
    if strict:
        require(df, features)
    w = Window.partitionBy(key).orderBy(*order)
    out = {}
    for f in features:
        value = F.lit(None).cast("double") if f not in df.columns else number(F.col(f).cast("string")) if numeric else F.col(f)
        for k in range(1, lags + 1):
            past = F.lag(value, k).over(w)
            out[f"{f}_past_{k}"] = past if missing is None else F.coalesce(past, F.lit(missing))
    return df.withColumns(out) if out else df


def add_time_lags(df: DataFrame, key: str, time: str, features: Sequence[str], lags: int, step: str = "1 hour") -> DataFrame:
    """Like add_lags, but the value exactly k steps earlier; NULL where that time is absent. (key, time) must be unique."""
    require(df, [key, time, *features])
    source = df.select(F.col(key), *[F.col(f) for f in features], F.col(time).alias("__t"))
    moved = F.explode(F.sequence(F.lit(1), F.lit(lags))).alias("__k")
    shifted = source.select("*", moved).withColumn(time, F.col("__t") + F.col("__k") * F.expr(f"interval {step}"))
    past = [F.max(F.when(F.col("__k") == k, F.col(f))).alias(f"{f}_past_{k}") for f in features for k in range(1, lags + 1)]
    return df.join(shifted.groupBy(key, time).agg(*past), [key, time], "left")


def row_ids(df: DataFrame, order: Sequence[str | Column], name: str = "row_id", start: int = 0) -> DataFrame:
    """Dense row numbers by ``order``, without one window over all rows.

    Rows are range-partitioned, sorted and numbered within their partition, and stored,
    because a second range partitioning could cut elsewhere. Partition counts, one row
    a partition, then give each partition's first number.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id())
    stored = written(ordered, "rows").withColumn("__p", F.shiftright("__at", 33))
    counts = stored.groupBy("__p").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = counts.select("__p", (before + F.lit(start)).alias("__first"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(F.broadcast(firsts), "__p").withColumn(name, F.col("__first") + within).drop("__p", "__at", "__first")


def dense_position(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Position from 0 of each row of a small table, such as one of places."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
