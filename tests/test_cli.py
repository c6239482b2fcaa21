import json
import os

import pytest

from vantle import cli
from vantle.sources import feeds, shapes


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write(text)
    return path


def rows(spark, path):
    return [r.asDict() for r in spark.read.option("header", True).csv(path).collect()]


@pytest.fixture()
def inputs(tmp_path):
    air, wind = ["zip,time,us_aqi,city"], ["zip,time,wind_speed_10m,wind_speed_100m,wind_direction_10m,wind_direction_100m"]
    for z in ("77002", "77003"):
        for h in range(10):
            air.append(f"{z},2026-03-05T{h:02}:00,{h * 3 % 7},H")
            wind.append(f"{z},2026-03-05 {h:02}:00:00,2,4,{h * 30},90")
    square = lambda x: [[(x, 29.0), (x, 29.02), (x + 0.02, 29.02), (x + 0.02, 29.0), (x, 29.0)]]
    shapes.write_shapes(str(tmp_path / "zip.shp"), 5, [({"GEOID20": "77002"}, square(-95.0)), ({"GEOID20": "77003"}, square(-95.05)), ({"GEOID20": "99999"}, square(-90.0))])
    shapes.write_shapes(str(tmp_path / "road.shp"), 3, [({"n": "a"}, [[(-95.1, 29.0), (-94.9, 29.0)]])])
    return ["--air-quality", put(tmp_path, "a.csv", "\n".join(air)), "--weather", put(tmp_path, "w.csv", "\n".join(wind)), "--tri-facilities", put(tmp_path, "f.csv", "trifd,latitude,longitude,total_air_emissions_lbs\nF,29.01,-94.97,5\nG,bad,1,1\n"), "--tri-chemicals", put(tmp_path, "c.csv", "trifd,chemical,total_air_emissions_lbs\nF,x,1\nF,y,2\n"), "--zip-shapefile", str(tmp_path / "zip.shp"), "--roads-shapefile", str(tmp_path / "road.shp"), "--output-dir", str(tmp_path / "out")]


def test_features(spark, inputs, tmp_path):
    cli.main(["features", *inputs, "--feats-for-past", "us_aqi", "--num-past-feats", "2", "--left-drop-columns", "city"], spark)
    got = rows(spark, str(tmp_path / "out" / "features"))
    assert len(got) == 20 and "us_aqi_past_2" in got[0] and "city" not in got[0] and "wind_direction_10m_sin" in got[0]
    assert any(float(r["facility_impact_score"]) > 0 for r in got) and any(float(r["road_impact_score"]) > 0 for r in got)
    summary = json.load(open(tmp_path / "out" / "metadata" / "summary.json"))
    assert summary["rows"]["rows_written"] == 20 and "merge_and_transform" in summary["seconds"]


def test_batch_and_tensor(spark, inputs, tmp_path):
    cli.main(["batch", *inputs, "--output-mode", "split"], spark)
    fixed = rows(spark, str(tmp_path / "out" / "time_invariant"))
    assert [r["zip"] for r in fixed] == ["77002", "77003"] and all(r["overall_spatial_impact_score"] for r in fixed)
    cli.main(["tensor", *inputs, "--npy"], spark)
    about = json.load(open(tmp_path / "out" / "tensor.json"))
    assert about["sizes"] == {"train": 7, "val": 2, "test": 1} and os.path.exists(tmp_path / "out" / "train.npy")


def test_small_commands(spark, tmp_path):
    a = put(tmp_path, "l.csv", "zip,time,x\na,1,5\na,2,6\n")
    b = put(tmp_path, "r.csv", "zip,time,y\na,2,7\n")
    cli.main(["merge", "--left", a, "--right", b, "--output", str(tmp_path / "m")], spark)
    assert {(r["time"], r["x"], r["y"]) for r in rows(spark, str(tmp_path / "m"))} == {("1", "5", "nan"), ("2", "6", "7")}
    t = put(tmp_path, "t.csv", " time ;v;e\n2026-03-05 12:34:56-06:00;1; \n")
    cli.main(["tidy", "--input", t, "--delimiter", ";", "--strip-time", "time", "--drop-empty", "--drop", "v", "--profile", "empty", "--output", str(tmp_path / "o")], spark)
    (row,) = rows(spark, str(tmp_path / "o"))
    assert [v.strip() for v in row.values()] == ["2026-03-05 12:34:56"]
    g = put(tmp_path, "g.csv", "zip,time\na,2026-01-01 00:00:00\na,2026-01-01 01:00:00\nb,2026-01-01 01:00:00\n")
    cli.main(["audit", "--input", g, "--output-dir", str(tmp_path / "audit")], spark)
    assert len(rows(spark, str(tmp_path / "audit" / "missing_pairs"))) == 1
    c = put(tmp_path, "k.csv", "zip,latitude,longitude\n77002,1,2\n77002,3,4\n")
    cli.main(["coordinates", "--input", c, "--output", str(tmp_path / "k.json")], spark)
    assert json.load(open(tmp_path / "k.json")) == {"77002": {"latitude": 1.0, "longitude": 2.0}}
    os.mkdir(tmp_path / "in")
    put(tmp_path / "in", "feb_1_weather_x.csv", "zip,v\na,1\n")
    cli.main(["ingest", "--input-dir", str(tmp_path / "in"), "--output-dir", str(tmp_path / "master")], spark)
    assert feeds.master(spark, "weather", str(tmp_path / "master" / "weather"), str(tmp_path / "master" / "weather.json")).count() == 1
