"""Column-level operators: dropping, pruning by content, selecting and checking."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import CALENDAR


def require(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def drop_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Without the columns. Keys can't be dropped; absent columns raise if ``strict``."""
    held = [c for c in columns if c in keys]
    if held:
        raise ValueError(f"cannot drop key columns: {held}")
    if strict:
        require(df, columns)
    return df.drop(*[c for c in columns if c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without columns that hold nothing but NULL and white space; one pass over the data."""
    if not df.columns:
        return df
    full = df.agg(*[F.max(F.trim(F.col(f"`{c}`").cast("string")) != "").alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if full[c]])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named columns, under their new names."""
    require(df, names)
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where all columns are neither NULL nor NaN."""
    return df.dropna(subset=list(columns))


def keep_members(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; Spark picks broadcast by the measured size."""
    return df.join(keys.select(on if isinstance(on, str) else list(on)).distinct(), on, "left_semi")


def within_radius(d: str | Column, radius: float, open_at_zero: bool = False) -> Column:
    """d <= radius, and d > 0 if asked."""
    c = F.col(d) if isinstance(d, str) else d
    return (c <= radius) & (c > 0) if open_at_zero else c <= radius


def with_geometry(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Rows whose geometry has points."""
    return df.filter(F.col(parts).isNotNull() & F.exists(parts, lambda p: F.size(p) > 0))


def explode_parts(df: DataFrame, parts: str = "parts", part: str = "part") -> DataFrame:
    """One row a non-empty part."""
    return df.withColumn(part, F.explode(parts)).drop(parts).filter(F.size(part) > 0)


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """NULL replaced by a constant, or by another column's value where that is a Column."""
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in values.items()})


def split_invariant(df: DataFrame, key: str, order: Sequence[str], invariant: Sequence[str], time: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without the invariant columns, one row a key with them: the first by ``order``)."""
    require(df, [key, *invariant, *([time] if time else [])])
    first = F.min_by(F.struct(*invariant), F.struct(*order)).alias("f")
    return df.drop(*invariant), df.groupBy(key).agg(first).select(key, *[F.col(f"f.{c}").alias(c) for c in invariant])


def varying_within(df: DataFrame, key: str, columns: Sequence[str]) -> dict[str, int]:
    """column -> keys for which it has more than one value, NULL being one; only columns with such keys."""
    many = lambda c: F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))
    per = df.groupBy(key).agg(*[many(c).alias(c) for c in columns])
    got = per.agg(*[F.sum((F.col(c) > 1).cast("int")).alias(c) for c in columns]).first()
    return {c: got[c] for c in columns if got[c]}


def output_columns(left: Sequence[str], right: Sequence[str], keys: Sequence[str], directions: Sequence[str] = (), drop_directions: bool = True, lagged: Sequence[str] = (), lags: int = 0, scores: Sequence[str] = ("road_impact_score", "facility_impact_score")) -> list[str]:
    """Order of the feature table: keys, left, right, direction pairs, calendar, scores, lags; each name once."""
    base = [*keys, *left, *right]
    if drop_directions:
        base = [c for c in base if c in keys or c not in set(directions)]
    pairs = [f"{c}_{n}" for c in directions for n in ("sin", "cos")]
    past = [f"{c}_past_{k}" for c in lagged for k in range(1, lags + 1)]
    return list(dict.fromkeys([*base, *pairs, *CALENDAR, *scores, *past]))
