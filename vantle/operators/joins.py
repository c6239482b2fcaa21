"""Keyed joins with explicit policies for repeated keys and shared column names.

Equi-joins are left to Catalyst: broadcast where statistics show a small side, else
sort-merge with adaptive skew splitting. Nothing here forces a broadcast by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def _side(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keys, the other columns as one struct, and the order columns, of one side."""
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = F.struct(F.lit(1).alias("__"), *[F.col(c) for c in df.columns if c not in keys])
    return df.select(*keys, F.lit(name).alias("__side"), rest.alias(f"__{name}"), *[c.alias(f"__{name}{i}") for i, c in enumerate(sort)])


def pairing_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str | Column], right_order: Sequence[str | Column], how: str = "full_outer", overlap: str = "right", marker: str | None = None, cluster: Sequence[str] | None = None) -> DataFrame:
    """Join in which the k-th row of a key on the left meets the k-th on the right; the rest stay alone.

    overlap: columns on both sides that are no keys. ``right``: the right side's value,
    so missing on a left-only row; ``left``: the left side's; ``coalesce``: left, else
    right; ``error``: raise. marker: name of a column with both / left_only / right_only.
    Rows with a NULL key pair with rows of the same NULL key.

    Both sides are stacked and dealt once by the ``cluster`` keys (all keys by default);
    ranks within a side and the pairing of equal ranks both work on that one exchange,
    and so do later windows over the cluster keys.
    """
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    if overlap == "error" and shared:
        raise ValueError(f"columns on both sides: {shared}")
    if overlap not in ("right", "left", "coalesce", "error"):
        raise ValueError(f"unknown overlap policy {overlap!r}")
    a, b = _side(left, "l", keys, left_order), _side(right, "r", keys, right_order)
    stacked = a.unionByName(b, allowMissingColumns=True)
    order = [c for c in stacked.columns if c.startswith(("__l", "__r")) and c not in ("__l", "__r")]
    ranked = stacked.repartition(*(cluster or keys)).withColumn(RANK, F.row_number().over(Window.partitionBy(*keys, "__side").orderBy(*order)))
    joined = ranked.groupBy(*keys, RANK).agg(F.first("__l", True).alias("__l"), F.first("__r", True).alias("__r"))
    in_left, in_right = F.col("__l").isNotNull(), F.col("__r").isNotNull()
    wanted = {"full_outer": None, "outer": None, "inner": in_left & in_right, "left": in_left, "right": in_right}
    if how not in wanted:
        raise ValueError(f"unknown kind of join {how!r}")
    if wanted[how] is not None:
        joined = joined.filter(wanted[how])
    pick = {"right": lambda c: F.col(f"__r.{c}"), "left": lambda c: F.col(f"__l.{c}"), "coalesce": lambda c: F.coalesce(f"__l.{c}", f"__r.{c}")}.get(overlap)
    out = [F.col(k) for k in keys]
    out += [(pick(c) if c in shared else F.col(f"__l.{c}")).alias(c) for c in left.columns if c not in keys]
    out += [F.col(f"__r.{c}").alias(c) for c in right.columns if c not in keys and c not in shared]
    if marker:
        out.append(F.when(in_left & in_right, "both").when(in_left, "left_only").otherwise("right_only").alias(marker))
    return joined.select(*out)


def left_wins_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on the keys, every match a row; of shared columns the left side's stay."""
    extra = [c for c in right.columns if c in keys or c not in left.columns]
    return left.join(right.select(*extra), list(keys), "inner")


def timestep_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, left_order: Sequence[str], right_order: Sequence[str], cluster: Sequence[str] | None = None) -> DataFrame:
    """Full outer pairing join over the timesteps of both sides, shared columns being an error.

    Timestep numbers (see timestep_ids) rise one to one with the times, so pairing on
    the times themselves gives the same rows without numbering them first.
    """
    if time not in keys:
        raise ValueError(f"time column {time!r} is no key")
    return pairing_join(left, right, keys, left_order, right_order, "full_outer", "error", cluster=cluster)


def timestep_ids(left: DataFrame, right: DataFrame, time: str) -> DataFrame:
    """(time, timestep): distinct times of both sides numbered from 1."""
    times = left.select(time).union(right.select(time)).filter(F.col(time).isNotNull()).distinct()
    return times.withColumn("timestep", F.row_number().over(Window.orderBy(time)))


def lookup_join(df: DataFrame, values: DataFrame, on: str | Sequence[str], fill: dict[str, object] | None = None) -> DataFrame:
    """Left join; columns of ``fill`` get that value only where no row was found."""
    keys = [on] if isinstance(on, str) else list(on)
    found = df.join(values.withColumn("__hit", F.lit(True)), keys, "left")
    for c, v in (fill or {}).items():
        found = found.withColumn(c, F.when(F.col("__hit").isNull(), F.lit(v)).otherwise(F.col(c)))
    return found.drop("__hit")


def missing_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of df that ``keys`` lacks."""
    names = [on] if isinstance(on, str) else list(on)
    return df.select(*names).distinct().join(keys.select(*names), names, "left_anti")


def match_counts(joined: DataFrame, marker: str) -> DataFrame:
    """(matched_rows, left_only_rows, right_only_rows, rows_written) of a marked join."""
    n = lambda v: F.count(F.when(F.col(marker) == v, 1))
    return joined.agg(n("both").alias("matched_rows"), n("left_only").alias("left_only_rows"), n("right_only").alias("right_only_rows"), F.count("*").alias("rows_written"))


def distance_join(left: DataFrame, right: DataFrame, radius: float, left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("sx", "sy"), d: str = "dist_m", open_at_zero: bool = False) -> DataFrame:
    """Pairs at most ``radius`` apart, with their distance.

    Both sides are dealt to square cells of the radius; the right side goes to its own
    cell and the eight around it, so an equi-join on the cell meets every pair once.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(radius)))
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = left.withColumn("__i", cell(left_xy[0])).withColumn("__j", cell(left_xy[1]))
    b = right.withColumn("__n", F.explode(near)).withColumn("__i", cell(right_xy[0]) + F.col("__n.i")).withColumn("__j", cell(right_xy[1]) + F.col("__n.j")).drop("__n")
    dx, dy = F.col(left_xy[0]) - F.col(right_xy[0]), F.col(left_xy[1]) - F.col(right_xy[1])
    pairs = a.join(b, ["__i", "__j"]).drop("__i", "__j").withColumn(d, F.sqrt(dx * dx + dy * dy))
    return pairs.filter((F.col(d) <= radius) & (F.col(d) > 0) if open_at_zero else F.col(d) <= radius)
