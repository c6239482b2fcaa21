import os

import duckdb
import pytest

import __spark_entry__ as driver
from vantle.operators import impact
from vantle.plans import catalog, catalog_files, demo, pipelines


def norm(rows):
    return sorted(tuple("" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in catalog.ORACLES))
def test_against_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    other = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in other.description]
    assert sorted(names) == columns
    want = [[row[names.index(c)] for c in columns] for row in other.fetchall()]
    assert norm([[r[c] for c in columns] for r in df.collect()]) == norm(want)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_stream_pipeline_prunes(spark, sf):
    config = pipelines.FeatureConfig(lagged=("us_aqi",), lags=1, cardinality_threshold=3, variance_threshold=0.001, right_drop=("latitude",))
    p = demo.places(spark, sf)
    fac = impact.enrich_facilities(demo.facilities(spark, sf), demo.chemicals(spark, sf))
    lookup = impact.pair_lookup(p, impact.facility_pairs(p, fac, 9000.0), impact.road_pairs(p, demo.roads(spark, sf), 9000.0))
    out, report = pipelines.stream_features(demo.air(spark, sf), demo.weather(spark, sf), ["aq_id"], ["wx_id"], config, lookup)
    assert {"cardinality_filter", "variance_filter"} <= set(report.seconds)
    assert out.columns[:2] == ["zip", "time"] and "road_impact_score" in out.columns and "wind_direction_10m" not in out.columns


def test_batch_split_and_tensor(spark, sf):
    wide = lambda df: df.withColumn("zip", demo.F.lpad("zip", 5, "0"))
    a, b = wide(demo.air(spark, sf)), wide(demo.weather(spark, sf))
    table, fixed, report = pipelines.batch_features(a, b, ["aq_id", "wx_id"], pipelines.FeatureConfig(variance_threshold=0.0), None, ["latitude", "absent"])
    assert fixed.columns == ["zip", "latitude"] and "latitude" not in table.columns and "invariant_columns" in report.notes
    if table.select("time").distinct().count() >= 10:
        out, info = pipelines.tensor_features(a, b, ["aq_id", "wx_id"], config=pipelines.TensorConfig(sweeps=1))
        assert out.count() == info["shape"][0] * info["shape"][1] * info["shape"][2]
