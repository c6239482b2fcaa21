"""Plane geometry as column expressions: rings and lines are arrays of (x, y) structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import col

#: Fixed value: radius of the sphere of Web Mercator, in metres.
RADIUS = 6_378_137.0


def mercator(lon: str | Column, lat: str | Column) -> tuple[Column, Column]:
    """Web Mercator metres of degrees."""
    return F.lit(RADIUS) * F.radians(col(lon)), F.lit(RADIUS) * F.log(F.tan(F.pi() / 4 + F.radians(col(lat)) / 2))


def project_part(points: str | Column) -> Column:
    """A part's points in Web Mercator metres; x and y are degrees before."""

    def to(p: Column) -> Column:
        x, y = mercator(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(col(points), to)


def point(x: str | Column, y: str | Column) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = ax - bx, ay - by
    return F.sqrt(dx * dx + dy * dy)


def _moments(ring: Column) -> Column:
    """Signed double area and first moments of a ring, about its first point for accuracy."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    ox, oy = ring[0]["x"], ring[0]["y"]

    def add(acc: Column, i: Column) -> Column:
        p, q = F.get(ring, i), F.get(ring, (i + 1) % F.size(ring))
        px, py, qx, qy = p["x"] - ox, p["y"] - oy, q["x"] - ox, q["y"] - oy
        cross = px * qy - qx * py
        return F.struct((acc["a"] + cross).alias("a"), (acc["x"] + (px + qx) * cross).alias("x"), (acc["y"] + (py + qy) * cross).alias("y"))

    s = F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), zero, add)
    return F.struct(s["a"].alias("a"), (s["x"] + 3 * ox * s["a"]).alias("x"), (s["y"] + 3 * oy * s["a"]).alias("y"))


def centroid(rings: str | Column) -> Column:
    """Centre of area of a polygon's rings, all parts and holes; holes turn the other way and so count negative.

    NULL without rings; a polygon without area has the mean of its first ring's points.
    """
    parts = F.filter(col(rings), lambda r: F.size(r) > 0)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    add = lambda acc, m: F.struct((acc["a"] + m["a"]).alias("a"), (acc["x"] + m["x"]).alias("x"), (acc["y"] + m["y"]).alias("y"))
    total = F.aggregate(F.transform(parts, _moments), zero, add)
    first = parts[0]
    mean = lambda axis: F.aggregate(first, F.lit(0.0), lambda acc, p: acc + p[axis]) / F.size(first)
    flat = F.abs(total["a"]) < 1e-12
    xy = F.struct(F.when(flat, mean("x")).otherwise(total["x"] / (3 * total["a"])).alias("x"), F.when(flat, mean("y")).otherwise(total["y"] / (3 * total["a"])).alias("y"))
    return F.when(F.size(parts) > 0, xy)


def nearest_on_line(line: str | Column, x: Column, y: Column) -> Column:
    """(d, x, y): distance to a line and its nearest point; a single point is a line too; NULL if empty."""
    pts = col(line)
    starts = F.sequence(F.lit(0), F.greatest(F.size(pts) - 2, F.lit(0)))

    def near(i: Column) -> Column:
        a, b = F.get(pts, i), F.get(pts, F.least(i + 1, F.size(pts) - 1))
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        size = dx * dx + dy * dy
        t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - a["x"]) * dx + (y - a["y"]) * dy) / size))).otherwise(F.lit(0.0))
        nx, ny = a["x"] + t * dx, a["y"] + t * dy
        return F.struct(distance(x, y, nx, ny).alias("d"), nx.alias("x"), ny.alias("y"))

    return F.when(F.size(pts) > 0, F.array_min(F.transform(starts, near)))


def decay(d: str | Column, radius: float) -> Column:
    """exp(-d / radius)."""
    return F.exp(-col(d) / F.lit(float(radius)))
