"""From geometry and tables to the engine's places, facilities and road parts, all in Web Mercator metres."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import grid_cell, hilbert_index
from ..functions.normalize import CHEMICAL_HEADERS, FACILITY_HEADERS, PLACE_HEADERS, pick_columns, require_column, zip_first_digits, zip_padded
from ..functions.spatial import centroid, mercator, project_part
from ..operators.impact import numbered_parts
from ..operators.lags import dense_position
from ..operators.project import keep_members, with_geometry
from ..operators.stats import ranges


def place_centroids(polygons: DataFrame, keys: DataFrame | None = None, key: str = "zip") -> DataFrame:
    """(place, x, y): one centre a place; several polygons of a place count together.

    keys restricts to places that occur there; none left raises.
    """
    column = require_column(polygons.columns, PLACE_HEADERS, "place")
    rows = with_geometry(polygons.select(zip_first_digits(column).alias(key), "parts")).filter(F.col(key).isNotNull())
    if keys is not None:
        rows = keep_members(rows, keys.select(zip_first_digits(key).alias(key)), key)
        if rows.isEmpty():
            raise ValueError("no place of the data has a polygon")
    rings = F.transform(F.flatten(F.collect_list("parts")), project_part)
    whole = rows.groupBy(key).agg(centroid(rings).alias("c"))
    return whole.select(F.col(key).alias("place"), F.col("c.x").alias("x"), F.col("c.y").alias("y")).filter("x is not null")


def needed_polygons(polygons: DataFrame, data: DataFrame, key: str = "zip") -> tuple[DataFrame, DataFrame]:
    """(polygons of places in the data, places of the data without a polygon), by zero-filled place texts."""
    column = require_column(polygons.columns, PLACE_HEADERS, "place")
    marked = polygons.withColumn("__place", zip_padded(column))
    keys = data.select(zip_padded(key).alias("__place")).filter("__place <> ''").distinct()
    missing = keys.join(marked.select("__place"), "__place", "left_anti").withColumnRenamed("__place", key)
    return keep_members(marked, keys, "__place").drop("__place"), missing


def facility_table(facilities: DataFrame) -> DataFrame:
    """facility_id, lat, lon, amount and facility_name by the usual headers, and sx, sy in metres."""
    names = pick_columns(facilities.columns, FACILITY_HEADERS)
    none = {"amount": "double", "facility_name": "string"}
    out = facilities.select(*[(F.col(f"`{n}`") if n else F.lit(None).cast(none[role])).alias(role) for role, n in names.items()])
    x, y = mercator(F.col("lon").cast("string").try_cast("double"), F.col("lat").cast("string").try_cast("double"))
    return out.withColumns({"sx": x, "sy": y})


def chemical_table(chemicals: DataFrame) -> DataFrame:
    """facility_id, chemical, amount by the usual headers; without an amount column each row counts 1, and a warning says so."""
    names = pick_columns(chemicals.columns, CHEMICAL_HEADERS)
    if names["amount"] is None:
        warnings.warn(f"no amount column among {chemicals.columns}: every row counts 1", stacklevel=2)
    return chemicals.select(*[(F.col(f"`{n}`") if n else F.lit(1.0)).alias(role) for role, n in names.items()])


def hilbert_encode(rows: DataFrame, centroids: DataFrame, order: int = 8, key: str = "zip") -> tuple[DataFrame, DataFrame]:
    """(rows with their place's centre, cell, Hilbert index and position; that mapping, one row a place).

    centroids: place, x, y. Only places of the rows take part, so the grid spans them alone;
    rows of a place without a centre get NULLs. No place in common raises.
    """
    here = keep_members(centroids.withColumnRenamed("place", key), rows.select(key), key)
    ends = ranges(here, ["x", "y"])
    if ends.first()["min_x"] is None:
        raise ValueError("no place of the rows has a centre")
    cell = lambda c: grid_cell(c, F.col(f"min_{c}"), F.col(f"max_{c}"), 1 << order).alias(f"grid_{c}")
    cells = here.join(F.broadcast(ends)).select(key, F.col("x").alias("centroid_x_m"), F.col("y").alias("centroid_y_m"), cell("x"), cell("y"))
    mapping = dense_position(cells.withColumn("hilbert_index", hilbert_index("grid_x", "grid_y", order)), ["hilbert_index", key], "hilbert_position")
    return rows.join(mapping, key, "left"), mapping


def road_parts(lines: DataFrame) -> DataFrame:
    """(road_id, part) of all non-empty line parts, in record order."""
    return numbered_parts(lines.withColumn("parts", F.transform("parts", project_part)), "parts", ["record"])
