import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import types as T

from vantle.sources import feeds, shapes, tables
from vantle.streaming import feeds as streams


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write(text)
    return path


def test_csv(spark, tmp_path):
    path = put(tmp_path, "a.csv", "zip;ozone;note\n07002;1.5;x\n07003;\n07004;2;y;z\n")
    df = tables.read_csv(spark, path, ";")
    assert dict(df.dtypes) == {"zip": "string", "ozone": "double", "note": "string"}
    assert [tuple(r) for r in df.collect()] == [("07002", 1.5, "x"), ("07003", None, None), ("07004", 2.0, "y")]
    with pytest.raises(ValueError):
        tables.header(spark, put(tmp_path, "e.csv", ""))
    out = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame([("a", None, float("nan"))], "z string, m string, v double"), out, missing="nan", single_file=True)
    (part,) = [p for p in os.listdir(out) if p.startswith("part")]
    assert open(os.path.join(out, part)).read() == "z,m,v\na,nan,nan\n"


def test_concat_needs_equal_headers(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(1,)], "y int")
    assert tables.concat_tables([a, a]).count() == 2
    with pytest.raises(ValueError):
        tables.concat_tables([a, b])


def test_maps(spark, tmp_path):
    path = put(tmp_path, "m.json", 'mapping = {"77002": {"latitude": 1, "longitude": 2}}\n')
    assert tables.coordinate_map(spark, tables.read_json(path)).first()["longitude"] == 2.0
    tables.write_mapping(str(tmp_path / "o.py"), "place", {"a": 1})
    assert tables.read_json(str(tmp_path / "o.py")) == {"a": 1}
    df = spark.createDataFrame([(1, "77002", "x", "2"), (2, "77002-1", "3", "4"), (3, "77002", "5", "6")], "i int, z string, a string, o string")
    assert [tuple(r) for r in tables.first_coordinates(df, "z", "a", "o", ["i"]).collect()] == [("77002", 3.0, 4.0)]


def test_npy_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([(0, 1, 2.0), (1, 0, 3.0)], "t int, h int, value float")
    path = str(tmp_path / "x.npy")
    tables.export_npy(cells, path, (2, 2), ["t", "h"])
    assert np.isnan(np.load(path)).sum() == 2
    assert {tuple(r) for r in tables.import_npy(spark, path, ["t", "h"]).collect()} == {(0, 1, 2.0), (1, 0, 3.0)}


def test_shapes(spark, tmp_path):
    path = str(tmp_path / "z.shp")
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    shapes.write_shapes(path, 5, [({"GEOID20": "77002"}, [ring, ring]), ({"GEOID20": "77003"}, []), ({"GEOID20": "77004"}, [ring])])
    shapes.register(spark)
    rows = spark.read.format("shapes").option("rows", "2").load(path).orderBy("record").collect()
    assert [r["GEOID20"] for r in rows] == ["77002", "77003", "77004"] and [len(r["parts"]) for r in rows] == [2, 0, 1]
    assert [(p["x"], p["y"]) for p in rows[0]["parts"][0]] == ring
    shapes.write_shapes(str(tmp_path / "p.shp"), 1, [({"a": "b"}, [[(1.0, 2.0)]])])
    assert spark.read.format("shapes").load(str(tmp_path / "p.shp")).first()["parts"][0][0]["y"] == 2.0


NAMES = ["feb_4thweek_air_quality_hourly_20260312_210107.csv", "march_1stweek_air_quality_hourly_20260315_120000.csv", "dec_10_air_quality_hourly_20250101_000000.csv"]


def test_order_keys():
    assert feeds.order_key(NAMES[0])[:2] == (2, 4) and feeds.order_key(NAMES[1])[:2] == (3, 1)
    assert feeds.order_key(NAMES[2]) > feeds.order_key(NAMES[0]) and feeds.order_key(NAMES[2], True) < feeds.order_key(NAMES[0], True)
    for bad in ("x.csv", "foo_1_air_quality_.csv", "feb_x_air_quality_.csv"):
        with pytest.raises(ValueError):
            feeds.order_key(bad)
    assert feeds.kind_of("Feb_1_WEATHER_x.CSV") == "weather" and feeds.kind_of("feb_1_weather_x.txt") is None


def test_ingestion(spark, tmp_path):
    box, table, state = str(tmp_path / "in"), str(tmp_path / "master"), str(tmp_path / "state.json")
    os.mkdir(box)
    put(box, NAMES[0], "zip,v\na,1\nb,2\n")
    run = lambda: feeds.ingest(spark, "air_quality", feeds.find_files(spark, box)["air_quality"], table, state)
    assert run().action == "rebuild" and run().action == "skip"
    put(box, NAMES[1], "zip,v\nc,3\n")
    assert run().action == "append"
    put(box, "jan_1_air_quality_x.csv", "zip,v\nz,0\n")
    assert run().action == "rebuild"
    assert [r["v"] for r in feeds.master(spark, "air_quality", table, state).collect()] == ["0", "1", "2", "3"]
    put(box, "apr_1_air_quality_x.csv", "zip,w\nz,0\n")
    with pytest.raises(ValueError):
        run()


def test_streams(spark, tmp_path):
    box = str(tmp_path / "in")
    os.mkdir(box)
    schema = T.StructType([T.StructField("zip", T.StringType()), T.StructField("t", T.IntegerType()), T.StructField("v", T.DoubleType())])
    put(box, "1.csv", "zip,t,v\na,1,1\na,2,2\nb,1,5\n")
    table, check = str(tmp_path / "t"), str(tmp_path / "c")
    go = lambda: streams.append_available(streams.feed_stream(spark, box, schema), table, check).awaitTermination()
    go(), go()
    assert spark.read.parquet(table).count() == 3
    put(box, "2.csv", "zip,t,v\na,2,9\n")
    go()
    assert spark.read.parquet(table).count() == 4
    merged, mark = str(tmp_path / "u"), str(tmp_path / "d")
    up = lambda: streams.upsert_available(streams.feed_stream(spark, box, schema, files_per_trigger=1), merged, mark, ["zip", "t"], "zip").awaitTermination()
    up()
    assert {(r["zip"], r["t"]) for r in spark.read.parquet(merged).collect()} == {("a", 1), ("a", 2), ("b", 1)}
    assert {r["v"] for r in spark.read.parquet(merged).filter("zip = 'a' and t = 2").collect()} == {9.0}
    put(box, "3.csv", "zip,t,v\na,1,7\n")
    up()
    assert {(r["t"], r["v"]) for r in spark.read.parquet(merged).filter("zip = 'a' and t = 1").collect()} == {(1, 7.0)}


def test_stream_lags_and_statistics(spark, tmp_path):
    box = str(tmp_path / "in")
    os.mkdir(box)
    schema = T.StructType([T.StructField("zip", T.StringType()), T.StructField("t", T.IntegerType()), T.StructField("v", T.DoubleType())])
    put(box, "1.csv", "zip,t,v\na,1,1\na,2,2\n")
    stream = streams.feed_stream(spark, box, schema).drop("source_file", "arrival")
    q = streams.running_statistics(stream, ["v"]).writeStream.format("memory").queryName("stats_v").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    row = spark.table("stats_v").first()
    assert (row["n_v"], row["mean_v"], row["variance_v"]) == (2, 1.5, 0.25)
    q = streams.stream_lags(stream, "zip", "t", ["v"], 2).writeStream.format("memory").queryName("lags_v").outputMode("append").start()
    q.processAllAvailable()
    put(box, "2.csv", "zip,t,v\na,3,3\n")
    q.processAllAvailable()
    q.stop()
    got = {r["t"]: (r["v_past_1"], r["v_past_2"]) for r in spark.table("lags_v").collect()}
    assert got[3] == (2.0, 1.0) and got[2][0] == 1.0


def test_stream_join(spark, tmp_path):
    schema = T.StructType([T.StructField("zip", T.StringType()), T.StructField("time", T.TimestampType()), T.StructField("v", T.IntegerType())])
    sides = []
    for side in "ab":
        box = str(tmp_path / side)
        os.mkdir(box)
        put(box, "1.csv", f"zip,time,v\nx,2024-01-01 00:00:00,1\n{side},2024-01-01 01:00:00,2\n")
        sides.append(streams.feed_stream(spark, box, schema).drop("source_file", "arrival").withColumnRenamed("v", f"v_{side}"))
    q = streams.stream_join(*sides, "zip", "time").writeStream.format("memory").queryName("both_sides").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    rows = [tuple(r) for r in spark.table("both_sides").collect()]
    assert ("x", dt.datetime(2024, 1, 1), 1, 1) in rows


def test_stored_tables_are_dropped(spark, monkeypatch):
    from vantle import session

    monkeypatch.setattr(session, "_WRITTEN", [])
    path = session.written(spark.range(3), "gone").inputFiles()[0]
    assert session.drop_written(spark) == 1 and not os.path.exists(path.removeprefix("file://"))


def test_a_stored_table_has_no_files_beside_its_own(spark):
    """Every file that Hadoop creates on a local disk starts a process: one a partition and the marker, no checksum files."""
    from vantle import session

    stored = session.written(spark.range(30).repartition(3), "plain")
    folder = os.path.dirname(stored.inputFiles()[0].removeprefix("file://"))
    names = sorted(os.listdir(folder))
    assert names[0] == "_SUCCESS" and len(names) == 4 and all(x.endswith(".parquet") for x in names[1:])
    assert sorted(r.id for r in stored.collect()) == list(range(30))


def test_chemicals_without_an_amount_are_reported(spark):
    from vantle.plans import geography

    df = spark.createDataFrame([("F", "x")], "`TRIFID` string, `CHEMICAL NAME` string")
    with pytest.warns(UserWarning, match="no amount column"):
        assert [tuple(r) for r in geography.chemical_table(df).collect()] == [("F", "x", 1.0)]


def test_names_with_odd_characters(spark, tmp_path):
    box = tmp_path / "in put+1%"
    box.mkdir()
    put(box, "jan_1_weather_a+b%20c.csv", 'zip,v\n"x,1",1\ny,2\n')
    found = feeds.find_files(spark, str(box))["weather"]
    assert len(found) == 1
    feeds.ingest(spark, "weather", found, str(tmp_path / "m"), str(tmp_path / "s.json"))
    assert [(r["zip"], r["v"]) for r in feeds.master(spark, "weather", str(tmp_path / "m"), str(tmp_path / "s.json")).collect()] == [("x,1", "1"), ("y", "2")]


def test_failed_batches_are_not_read(spark, tmp_path):
    box, table, state = str(tmp_path / "in"), str(tmp_path / "master"), str(tmp_path / "state.json")
    os.mkdir(box)
    put(box, NAMES[0], "zip,v\na,1\n")
    feeds.ingest(spark, "air_quality", feeds.find_files(spark, box)["air_quality"], table, state)
    # rows of a run that ended before its manifest
    spark.read.option("recursiveFileLookup", True).parquet(table).write.parquet(f"{table}/batch-lost")
    assert feeds.master(spark, "air_quality", table, state).count() == 1
