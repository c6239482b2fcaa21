"""Impact of point sources and lines on places: pair lookups, static scores and wind-driven scores.

Places, sources and parts are tables of their own; pairs within a radius come from a
cell-wise distance join. Lookups hold one row a place with arrays of pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import wind_vector
from ..functions.normalize import clip01, number
from ..functions.spatial import decay, nearest_on_line
from ..session import written
from .joins import distance_join, lookup_join
from .lags import row_ids
from .project import fill
from .stats import scale_of


@dataclass(frozen=True)
class ImpactConfig:
    """Radii in metres and the wind each kind of source sees."""

    road_radius: float = 2_000.0
    facility_radius: float = 10_000.0
    road_wind: str = "10m"
    road_blend: float = 0.0
    facility_wind: str = "blend"
    facility_blend: float = 0.7


def enrich_facilities(facilities: DataFrame, chemicals: DataFrame, amount_fallback: str = "none") -> DataFrame:
    """facility_id, lat, lon, amount, chemical_count.

    A facility without a usable amount has 0, or the sum of its chemicals' amounts with
    ``amount_fallback='chemicals'``. Facilities without coordinates drop out; chemicals
    without facility count nowhere.
    """
    if amount_fallback not in ("none", "chemicals"):
        raise ValueError(f"unknown fallback {amount_fallback!r}")
    per = chemicals.filter(F.col("facility_id").isNotNull()).groupBy("facility_id").agg(F.sum(F.coalesce(number("amount"), F.lit(0.0))).alias("chemical_amount"), F.count_distinct("chemical").alias("chemical_count"))
    base = facilities.withColumns({"lat": number("lat"), "lon": number("lon"), "amount": number("amount")}).dropna(subset=["lat", "lon"])
    other = F.coalesce("chemical_amount", F.lit(0.0)) if amount_fallback == "chemicals" else F.lit(0.0)
    return base.join(per, "facility_id", "left").withColumn("amount", F.coalesce(F.nanvl("amount", F.lit(None).cast("double")), other)).withColumn("chemical_count", F.coalesce("chemical_count", F.lit(0))).drop("chemical_amount")


def facility_pairs(places: DataFrame, facilities: DataFrame, radius: float, open_at_zero: bool = True) -> DataFrame:
    """Pairs in the radius with distance, direction source to place, severity and decay.

    places: place, x, y; facilities: facility_id, amount, chemical_count, sx, sy. Scales
    of severity come from the pairs themselves, one row; the pairs are stored for that.
    """
    pairs = written(distance_join(places, facilities, radius, open_at_zero=open_at_zero), "pairs")
    scale = scale_of(pairs)
    dx, dy, d = F.col("x") - F.col("sx"), F.col("y") - F.col("sy"), F.col("dist_m")
    severity = 0.7 * clip01(F.col("amount") / F.col("amount_scale")) + 0.3 * clip01(F.col("chemical_count") / F.col("count_scale"))
    return pairs.join(F.broadcast(scale)).withColumns({"dir_x": F.try_divide(dx, d), "dir_y": F.try_divide(dy, d), "severity": severity, "decay": decay(d, radius)}).drop("amount_scale", "count_scale")


def road_parts_near(places: DataFrame, parts: DataFrame, radius: float) -> DataFrame:
    """Every part within the radius of a place, with its nearest point.

    A part enters the cells that its bounding box, widened by the radius, touches, so
    the join is on cells; the exact distance decides. parts: road_id, part.
    """
    xs, ys = F.transform("part", lambda p: p["x"]), F.transform("part", lambda p: p["y"])
    cell = lambda c: F.floor(c / F.lit(float(radius)))
    span = lambda v: F.sequence(cell(F.array_min(v) - F.lit(float(radius))), cell(F.array_max(v) + F.lit(float(radius))))
    dealt = parts.filter(F.size("part") > 0).withColumn("__i", F.explode(span(xs))).withColumn("__j", F.explode(span(ys)))
    met = places.withColumn("__i", cell(F.col("x"))).withColumn("__j", cell(F.col("y"))).join(dealt, ["__i", "__j"]).drop("__i", "__j")
    near = met.withColumn("near", nearest_on_line("part", F.col("x"), F.col("y"))).drop("part")
    return near.withColumn("dist_m", F.col("near.d")).filter(F.col("dist_m") <= radius)


def road_pairs(places: DataFrame, parts: DataFrame, radius: float) -> DataFrame:
    """Pairs in the radius, but not at distance 0, with direction part to place and decay."""
    near = road_parts_near(places, parts, radius).filter(F.col("dist_m") > 0)
    return near.withColumns({"dir_x": (F.col("x") - F.col("near.x")) / F.col("dist_m"), "dir_y": (F.col("y") - F.col("near.y")) / F.col("dist_m"), "decay": decay("dist_m", radius)}).drop("near")


def pair_lookup(places: DataFrame, facilities: DataFrame, roads: DataFrame) -> DataFrame:
    """One row a place: facility_pairs and road_pairs as sorted arrays, and how many sources each has.

    The arrays hold the sources around one place, which the radius bounds.
    """
    f = facilities.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("facility_id", "dir_x", "dir_y", "decay", "severity"))).alias("facility_pairs"), F.count_distinct("facility_id").alias("facility_count_nearby"))
    r = roads.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("road_id", "dir_x", "dir_y", "decay"))).alias("road_pairs"), F.count_distinct("road_id").alias("road_count_nearby"))
    out = places.select("place").distinct().join(f, "place", "left").join(r, "place", "left")
    return fill(out, {"facility_pairs": F.array().cast(f.schema["facility_pairs"].dataType), "road_pairs": F.array().cast(r.schema["road_pairs"].dataType), "facility_count_nearby": 0, "road_count_nearby": 0})


def _downwind(pairs: str, wx: Column, wy: Column, weighted: bool) -> Column:
    """Fold over a place's pairs; a missing wind gives NULL unless there are no pairs."""
    share = lambda p: (p["severity"] if weighted else F.lit(1.0)) * p["decay"]

    def add(acc: Column, p: Column) -> Column:
        along = wx * p["dir_x"] + wy * p["dir_y"]
        return acc + share(p) * F.when(along.isNotNull(), F.greatest(along, F.lit(0.0)))

    return F.aggregate(pairs, F.lit(0.0), add)


def wind_scores(df: DataFrame, lookup: DataFrame, place: str, config: ImpactConfig = ImpactConfig()) -> DataFrame:
    """road_impact_score and facility_impact_score of every row: decayed wind blowing from source to place.

    A place that the lookup lacks scores 0.
    """
    rx, ry = wind_vector(df, config.road_wind, config.road_blend)
    fx, fy = wind_vector(df, config.facility_wind, config.facility_blend)
    pairs = lookup.select(F.col("place").alias(place), "facility_pairs", "road_pairs")
    base = df.withColumns({"__rx": rx, "__ry": ry, "__fx": fx, "__fy": fy})
    met = lookup_join(base, pairs.withColumn("__known", F.lit(True)), place)
    known = F.coalesce("__known", F.lit(False))
    score = lambda column, x, y, weighted: F.when(known, _downwind(column, F.col(x), F.col(y), weighted)).otherwise(F.lit(0.0))
    return met.withColumns({"road_impact_score": score("road_pairs", "__rx", "__ry", False), "facility_impact_score": score("facility_pairs", "__fx", "__fy", True)}).drop("__rx", "__ry", "__fx", "__fy", "__known", "facility_pairs", "road_pairs")


def static_scores(places: DataFrame, facilities: DataFrame, parts: DataFrame, config: ImpactConfig = ImpactConfig()) -> DataFrame:
    """One row a place: distances and scores that don't depend on wind, each divided by the largest.

    The road score needs the nearest part at any distance: cells find it within the
    radius, and wider cells for places without one there.
    """
    near = road_parts_near(places, parts, config.road_radius).groupBy("place").agg(F.min("dist_m").alias("d"))
    alone = places.join(near.select("place"), "place", "left_anti")
    far = nearest_far(alone, parts, config.road_radius)
    roads = near.unionByName(far).select("place", F.col("d").alias("road_distance_m"), decay("d", config.road_radius).alias("__road"))
    pairs = facility_pairs(places, facilities, config.facility_radius, open_at_zero=False)
    per = pairs.groupBy("place").agg(F.sum(F.col("severity") * F.col("decay")).alias("__raw"), F.count_distinct("facility_id").alias("facility_count_nearby"))
    out = fill(places.select("place").distinct().join(roads, "place", "left").join(per, "place", "left"), {"__raw": 0.0, "facility_count_nearby": 0})
    top = out.agg(F.greatest(F.max("__road"), F.lit(1e-12)).alias("__tr"), F.greatest(F.max("__raw"), F.lit(1e-12)).alias("__tf"))
    out = out.join(F.broadcast(top)).withColumns({"road_impact_score": F.col("__road") / F.col("__tr"), "facility_impact_score": F.col("__raw") / F.col("__tf")})
    out = out.withColumn("overall_spatial_impact_score", clip01(0.4 * F.col("road_impact_score") + 0.6 * F.col("facility_impact_score")))
    return out.select("place", "road_distance_m", "road_impact_score", "facility_count_nearby", "facility_impact_score", "overall_spatial_impact_score")


def nearest_far(places: DataFrame, parts: DataFrame, radius: float) -> DataFrame:
    """(place, d): distance to the nearest part, however far, for places without one within ``radius``.

    The radius grows fourfold until every place has a part, each time by the same join
    on cells; at most as often as the extent of the data allows.
    """
    ends = lambda axis, f: f(F.transform("part", lambda p: p[axis]))
    box = parts.filter(F.size("part") > 0).agg(F.min(ends("x", F.array_min)), F.max(ends("x", F.array_max)), F.min(ends("y", F.array_min)), F.max(ends("y", F.array_max))).first()
    here = places.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    found = places.select("place", F.lit(0.0).alias("d")).limit(0)
    if box[0] is None or here[0] is None:
        return found
    reach = max(box[1], here[1]) - min(box[0], here[0]) + max(box[3], here[3]) - min(box[2], here[2]) + radius
    left = places.select("place", "x", "y")
    while radius < 4 * reach and not left.isEmpty():
        radius *= 4
        near = written(road_parts_near(left, parts, radius).groupBy("place").agg(F.min("dist_m").alias("d")), "near")
        found = found.unionByName(near)
        left = written(left.join(near.select("place"), "place", "left_anti"), "left")
    return found


def attach_static(df: DataFrame, scores: DataFrame, place: str) -> DataFrame:
    """Static scores on fact rows; NULL where the place has none."""
    return df.join(scores.withColumnRenamed("place", place), place, "left")


def numbered_parts(lines: DataFrame, parts: str = "parts", order: list[str] | None = None) -> DataFrame:
    """(road_id, part): non-empty parts numbered in the order given."""
    each = lines.select(*(order or []), F.posexplode(parts).alias("__pos", "part")).filter(F.size("part") > 0)
    return row_ids(each, [*(order or []), "__pos"], "road_id").select("road_id", "part")
