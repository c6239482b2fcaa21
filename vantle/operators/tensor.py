"""Dense [time, feature, place] tensors as tables of cells, their chronological splits and gap filling."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def indexed(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): distinct values in order, numbered from 0. An axis is small beside the cells."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.withColumn(name, (F.row_number().over(Window.orderBy(column)) - 1).cast("int"))


def cells(df: DataFrame, time: str, place: str, features: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """(t_idx, f_idx, h_idx, value float): the observed cells.

    Of repeated cells the last value by ``order`` that is neither NULL nor NaN stays;
    rows without time or place have none.
    """
    times, places = indexed(df, time, "t_idx"), indexed(df, place, "h_idx")
    rows = df.join(times, time).join(places, place)
    at = F.struct(*(order or [F.lit(0)]))
    long = rows.select("t_idx", "h_idx", at.alias("__at"), F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("f_idx", "value"))
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("t_idx", "f_idx", "h_idx").agg(F.max_by("value", "__at").cast("float").alias("value"))


def shape(df: DataFrame, time: str, place: str, features: Sequence[str]) -> tuple[int, int, int]:
    row = df.agg(F.count_distinct(time), F.count_distinct(place)).first()
    return row[0], len(features), row[1]


def dense_slices(observed: DataFrame, n_places: int) -> DataFrame:
    """(t_idx, f_idx, values array<float>): places in order, NULL where nothing was observed. A cell seen twice raises.

    A slice's cells are sorted by place and each brings the NULLs before it, so a slice costs
    its cells and places, not their product.
    """
    inside = observed.filter(F.col("h_idx").between(0, n_places - 1))
    grouped = inside.groupBy("t_idx", "f_idx").agg(F.array_sort(F.collect_list(F.struct("h_idx", "value"))).alias("m"))
    none = F.lit(None).cast("float")
    last = lambda i: F.when(i > 0, F.get("m", i - 1)["h_idx"]).otherwise(-1)

    def piece(cell: Column, i: Column) -> Column:
        gap = cell["h_idx"] - last(i) - 1
        twice = F.raise_error(F.lit("a cell occurs twice in a slice")).cast("int")
        return F.concat(F.array_repeat(none, F.when(gap < 0, twice).otherwise(gap)), F.array(cell["value"].cast("float")))

    rest = F.array_repeat(none, F.lit(n_places - 1) - last(F.size("m")))
    return grouped.select("t_idx", "f_idx", F.concat(F.flatten(F.transform("m", piece)), rest).alias("values"))


def split_sizes(n: int, train: float, val: float, test: float | None = None) -> tuple[int, int, int]:
    """Steps of each part: floors of the shares, the rest to test. Bad shares or empty parts raise."""
    if test is not None and abs(train + val + test - 1) > 1e-6:
        raise ValueError("shares must add up to 1")
    if n < 3:
        raise ValueError("at least three time steps are needed")
    a, b = math.floor(n * train), math.floor(n * val)
    if min(a, b, n - a - b) <= 0:
        raise ValueError(f"empty part: {a}, {b}, {n - a - b}")
    return a, b, n - a - b


def split(observed: DataFrame, n_times: int, train: float, val: float, test: float | None = None) -> DataFrame:
    """Cells with their part and time index within it."""
    a, b, _ = split_sizes(n_times, train, val, test)
    t = F.col("t_idx")
    part = F.when(t < a, "train").when(t < a + b, "val").otherwise("test")
    return observed.withColumn("split", part).withColumn("t_idx", F.when(t < a, t).when(t < a + b, t - a).otherwise(t - a - b))


def _start(plane: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Half the sum of each cell's row mean and column mean over the seen cells; a line without any has the mean of all."""
    whole = plane[seen].mean(dtype=np.float64)
    known = np.where(seen, plane, 0)

    def means(axis: int) -> np.ndarray:
        n = seen.sum(axis)
        return np.where(n, known.sum(axis, dtype=np.float32) / np.maximum(n, 1), whole).astype(np.float32)

    return (means(1)[:, None] + means(0)[None, :]) / np.float32(2)


class Wavefronts:
    """The gaps of a plane by antidiagonal, in a copy with a frame of zeros.

    A sweep in row order lets a gap use the new values above and left of it and the old
    ones below and right, all on the neighbouring antidiagonals. So a whole antidiagonal
    is swept by array operations, and the values are those of the sweep cell by cell.
    """

    def __init__(self, plane: np.ndarray, gaps: np.ndarray):
        height, width = plane.shape
        self.framed = np.pad(plane, 1)
        self.stride = width + 2
        rows, columns = np.nonzero(gaps)
        order = np.argsort(rows + columns, kind="stable")
        rows, columns = rows[order], columns[order]
        spot = (rows + 1) * self.stride + columns + 1
        corner = (rows > 0) & (columns > 0)
        terms = np.sum([rows > 0, columns > 0, corner, rows < height - 1, columns < width - 1], axis=0, dtype=np.float32)
        edges = np.flatnonzero(np.diff(rows + columns)) + 1
        self.fronts = list(zip(*(np.split(x, edges) for x in (spot, corner, terms)), strict=True))

    def sweep(self) -> float:
        """Every gap becomes the mean of its terms once; the largest change."""
        cell, s, largest = self.framed.reshape(-1), self.stride, 0.0
        for spot, corner, terms in self.fronts:
            above, left = cell[spot - s], cell[spot - 1]
            plane = np.where(corner, above + left - cell[spot - s - 1], np.float32(0))
            value = (plane + above + left + cell[spot + s] + cell[spot + 1]) / terms
            largest = max(largest, float(np.fmax.reduce(np.abs(value - cell[spot]))))
            cell[spot] = value
        return largest


def fill_plane(plane: np.ndarray, sweeps: int = 50, tolerance: float = 1e-6) -> np.ndarray:
    """A [time, place] plane without NaN.

    Gaps start at the mean of their row's and column's means, then each sweep replaces
    every gap, in row order, by the mean of up + left - corner and its direct neighbours,
    as far as they exist. Sweeps end when no gap moves by ``tolerance``. An empty plane
    becomes zeros; observed cells never change.
    """
    plane = np.asarray(plane, np.float32)
    gaps = np.isnan(plane)
    if gaps.all():
        return np.zeros_like(plane)
    if not gaps.any():
        return plane.copy()
    fronts = Wavefronts(np.where(gaps, _start(plane, ~gaps), plane), gaps)
    with np.errstate(invalid="ignore", over="ignore"):
        for _ in range(sweeps):
            if fronts.sweep() < tolerance:
                break
    return fronts.framed[1:-1, 1:-1].copy()


def filled(parts: DataFrame, n_features: int, sizes: dict[str, int], n_places: int, sweeps: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """(split, f_idx, t_idx, h_idx, value): every cell of every part, gaps filled plane by plane.

    The sweeps depend on order, so a plane of one part and feature is one group.
    """
    frame = [F.struct(F.lit(s).alias("split"), F.lit(f).alias("f_idx")) for s in sizes for f in range(n_features)]
    spark = parts.sparkSession
    every = spark.range(1).select(F.explode(F.array(*frame)).alias("k")).select("k.split", "k.f_idx")
    rows = parts.select("split", "f_idx", "t_idx", "h_idx", "value").unionByName(every.select("split", "f_idx", F.lit(None).cast("int").alias("t_idx"), F.lit(None).cast("int").alias("h_idx"), F.lit(None).cast("float").alias("value")))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        plane = np.full((sizes[key[0]], n_places), np.nan, np.float32)
        pdf = pdf.dropna(subset=["t_idx"])
        plane[pdf["t_idx"].astype(int), pdf["h_idx"].astype(int)] = pdf["value"]
        out = fill_plane(plane, sweeps, tolerance)
        t, h = np.indices(out.shape)
        return pd.DataFrame({"split": key[0], "f_idx": np.int32(key[1]), "t_idx": t.ravel().astype(np.int32), "h_idx": h.ravel().astype(np.int32), "value": out.ravel()})

    return rows.groupBy("split", "f_idx").applyInPandas(run, "split string, f_idx int, t_idx int, h_idx int, value float")


def sequence_rows(values: DataFrame, n_features: int, n_places: int) -> DataFrame:
    """(split, t_idx, input array<float>): [feature, place] flattened to f * n_places + h."""
    at = (F.col("f_idx") * n_places + F.col("h_idx")).alias("at")
    listed = F.array_sort(F.collect_list(F.struct(at, "value")))
    return values.groupBy("split", "t_idx").agg(F.transform(listed, lambda c: c["value"]).alias("input"))


def sequence_cells(values: DataFrame, n_places: int, batch_first: bool = True) -> DataFrame:
    """(split, i0, i1, i2, value): the cells of a sequence input, [1, time, feature and place] or [time, 1, feature and place].

    With the sizes as dimensions, ``export_npy`` writes them as one array a split.
    """
    one, time = F.lit(0).alias("i0"), F.col("t_idx")
    lead = [one, time.alias("i1")] if batch_first else [time.alias("i0"), F.lit(0).alias("i1")]
    return values.select("split", *lead, (F.col("f_idx") * n_places + F.col("h_idx")).cast("int").alias("i2"), "value")
