import math

import pytest
from pyspark.sql import functions as F

from vantle.functions import features as f
from vantle.functions import spatial as sp


def hilbert(order, x, y):
    """The textbook loop."""
    n, d, s = 1 << order, 0, (1 << order) // 2
    while s:
        rx, ry = int((x & s) > 0), int((y & s) > 0)
        d += s * s * ((3 * rx) ^ ry)
        if ry == 0:
            if rx == 1:
                x, y = n - 1 - x, n - 1 - y
            x, y = y, x
        s //= 2
    return d


def test_hilbert_is_a_bijection(spark):
    cells = spark.range(256).select((F.col("id") % 16).cast("int").alias("x"), (F.col("id") / 16).cast("int").alias("y"))
    rows = cells.select("x", "y", f.hilbert_index("x", "y", 4).alias("d")).collect()
    assert sorted(r["d"] for r in rows) == list(range(256))
    assert all(r["d"] == hilbert(4, r["x"], r["y"]) for r in rows)


def test_grid_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (9.0,), (-1.0,)], "v double")
    got = [r["c"] for r in df.select(f.grid_cell("v", F.lit(0.0), F.lit(4.0), 5).alias("c")).collect()]
    assert got == [0, 2, 4, 0]
    assert df.select(f.grid_cell("v", F.lit(1.0), F.lit(1.0), 5).alias("c")).first()["c"] == 0


def test_calendar_of_missing_time(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    row = f.with_calendar(df, "t").first()
    assert row["month"] is None and row["is_weekend"] is None
    assert f.with_calendar(df, "t", weekend_of_missing=0).first()["is_weekend"] == 0


def test_calendar(spark):
    df = spark.sql("select timestamp'2026-03-07 18:00:00' as t")
    row = f.with_calendar(df, "t", year=True).first()
    assert (row["year"], row["month"], row["day"], row["hour"], row["day_of_week"], row["day_of_year"], row["is_weekend"]) == (2026, 3, 7, 18, 5, 66, 1)
    assert row["hour_sin"] == pytest.approx(-1) and row["month_sin"] == pytest.approx(1)


def test_wind(spark):
    assert f.blend_weight("10m", 0.4) == 0 and f.blend_weight("100M", 0.4) == 1 and f.blend_weight("blend", 0.4) == 0.4
    with pytest.raises(ValueError):
        f.blend_weight("5m", 0)
    df = spark.createDataFrame([(2.0, 4.0, 0.0, 90.0)], "wind_speed_10m double, wind_speed_100m double, wind_direction_10m double, wind_direction_100m double")
    with pytest.raises(ValueError):
        f.wind_vector(df)
    wide = f.with_directions(df)
    assert "wind_direction_10m" not in wide.columns
    x, y = f.wind_vector(wide, "blend", 0.5)
    row = wide.select(x.alias("x"), y.alias("y")).first()
    assert row["x"] == pytest.approx(1) and row["y"] == pytest.approx(2)


def test_scaling_without_range(spark):
    df = spark.createDataFrame([(5.0,), (None,)], "v double")
    assert [r["s"] for r in df.select(f.scaled("v", F.lit(5.0), F.lit(5.0)).alias("s")).collect()] == [0.0, 0.0]


def test_centroid_and_distance(spark):
    square = [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}, {"x": 0.0, "y": 0.0}]]
    df = spark.createDataFrame([(square,), ([],), ([[{"x": 1.0, "y": 1.0}, {"x": 3.0, "y": 1.0}]],)], "parts array<array<struct<x:double,y:double>>>")
    got = [r["c"] for r in df.select(sp.centroid("parts").alias("c")).collect()]
    assert (got[0]["x"], got[0]["y"]) == (2, 2) and got[1] is None and (got[2]["x"], got[2]["y"]) == (2, 1)
    line = spark.createDataFrame([([{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 0.0}],), ([{"x": 3.0, "y": 4.0}],), ([],)], "l array<struct<x:double,y:double>>")
    near = [r["n"] for r in line.select(sp.nearest_on_line("l", F.lit(5.0), F.lit(3.0)).alias("n")).collect()]
    assert near[0]["d"] == 3 and near[0]["x"] == 5 and near[1]["d"] == pytest.approx(math.sqrt(5)) and near[2] is None


def test_decay_and_mercator(spark):
    x, y = sp.mercator(F.lit(180.0), F.lit(0.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y"), sp.decay(F.lit(2.0), 2.0).alias("d")).first()
    assert row["x"] == pytest.approx(math.pi * 6378137) and abs(row["y"]) < 1e-6 and row["d"] == pytest.approx(math.exp(-1))
