"""Calendar, cyclic, direction, scaling and space-filling features as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import col, direction_columns, number

CYCLES = {"month": 12, "hour": 24, "day_of_week": 7}
CALENDAR = ("month", "month_sin", "month_cos", "day", "hour", "hour_sin", "hour_cos", "day_of_week", "day_of_week_sin", "day_of_week_cos", "day_of_year", "is_weekend")


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the value's share of its period."""
    angle = 2 * F.pi() * col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar(time: str | Column, year: bool = False, weekend_of_missing: int | None = None) -> dict[str, Column]:
    """name -> column of a timestamp's calendar features, Monday 0; ``weekend_of_missing`` stands where the time is NULL."""
    t = col(time)
    parts = {"month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t), "day_of_week": F.weekday(t), "day_of_year": F.dayofyear(t)}
    parts["is_weekend"] = F.when(t.isNull(), F.lit(weekend_of_missing).cast("int")).otherwise((parts["day_of_week"] >= 5).cast("int"))
    for name, period in CYCLES.items():
        parts[f"{name}_sin"], parts[f"{name}_cos"] = cyclic(parts[name], period)
    names = (("year",) if year else ()) + CALENDAR
    parts["year"] = F.year(t)
    return {n: parts[n] for n in names}


def with_calendar(df: DataFrame, time: str | Column, year: bool = False, weekend_of_missing: int | None = None) -> DataFrame:
    return df.withColumns(calendar(time, year, weekend_of_missing))


def with_directions(df: DataFrame, columns: Sequence[str] = (), detect: bool = True, drop: bool = True) -> DataFrame:
    """Degrees to ``_sin`` and ``_cos``; what is no number gives NULL."""
    found = direction_columns(df.columns, columns, detect)
    out = df.withColumns({f"{c}_{n}": f(F.radians(number(c))) for c in found for n, f in (("sin", F.sin), ("cos", F.cos))})
    return out.drop(*found) if drop else out


def blend_weight(mode: str, blend: float) -> float:
    """Share of the upper level: 0 for ``10m``, 1 for ``100m``, ``blend`` for ``blend``."""
    modes = {"10m": 0.0, "100m": 1.0, "blend": float(blend)}
    if str(mode).lower() not in modes:
        raise ValueError(f"unknown wind mode {mode!r}")
    return modes[str(mode).lower()]


WIND = tuple(f"wind_{what}" for what in ("speed_10m", "speed_100m", "direction_10m_cos", "direction_10m_sin", "direction_100m_cos", "direction_100m_sin"))


def wind_vector(df: DataFrame, mode: str = "10m", blend: float = 0.0) -> tuple[Column, Column]:
    """x and y of the wind, weighted between the two levels."""
    missing = [c for c in WIND if c not in df.columns]
    if missing:
        raise ValueError(f"wind needs columns {missing}")
    upper = blend_weight(mode, blend)
    part = lambda axis: (1 - upper) * number("wind_speed_10m") * number(f"wind_direction_10m_{axis}") + upper * number("wind_speed_100m") * number(f"wind_direction_100m_{axis}")
    return part("cos"), part("sin")


def scaled(c: str | Column, low: Column, high: Column) -> Column:
    """(c - low) / (high - low); 0 for every row, missing ones too, where there is no range."""
    return F.when(high > low, (col(c) - low) / (high - low)).otherwise(F.lit(0.0))


def grid_cell(c: str | Column, low: Column, high: Column, cells: int) -> Column:
    """Cell 0 .. cells - 1 of a value by half-even rounding; 0 where there is no range."""
    share = (col(c) - low) / (high - low)
    cell = F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.rint(share * F.lit(cells - 1)).cast("int")))
    return F.when(high > low, cell).otherwise(F.lit(0))


def hilbert_index(x: str | Column, y: str | Column, order: int) -> Column:
    """Place of grid cell (x, y) along the Hilbert curve of 2 ** order cells a side.

    A fold over the bits from the highest: each adds its quadrant and turns the frame.
    """
    n = 1 << order
    start = F.struct(col(x).cast("long").alias("x"), col(y).cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(acc: Column, s: Column) -> Column:
        rx, ry = (acc["x"].bitwiseAND(s) > 0).cast("long"), (acc["y"].bitwiseAND(s) > 0).cast("long")
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, F.lit(n - 1) - acc["x"]).otherwise(acc["x"]), F.when(flip, F.lit(n - 1) - acc["y"]).otherwise(acc["y"])
        d = acc["d"] + s * s * (3 * rx).bitwiseXOR(ry)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).cast("long").alias("x"), F.when(ry == 0, fx).otherwise(fy).cast("long").alias("y"), d.cast("long").alias("d"))

    bits = F.array(*[F.lit(1 << b).cast("long") for b in range(order - 1, -1, -1)])
    return F.aggregate(bits, start, step, lambda acc: acc["d"])
