"""Registered queries of sources, sinks, ingestion, streams and the command line.

Each writes a table of the session's data to the shared folder in some format, reads it
back through the engine, and returns what came back, so plain SQL over the table is
its oracle.
"""

from __future__ import annotations

import csv
import io
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import cli
from ..functions import normalize
from ..operators import impact, joins, ml, project, tensor
from ..session import shared_folder
from ..sources import feeds, shapes, store, tables
from ..streaming import feeds as streams
from . import demo, geography, pipelines, report
from .catalog import CAL, CELLS, FEEDS_SQL, IMPACT, PAIRED, PAIRS, PLACES_SQL, ROADS_SQL, SIN_COS, TIME, _cells, _facilities, _lookup, query, shown


def local(path: str) -> str:
    """A shared path as the mounted folder that it is; shapefiles need one."""
    if re.match(r"[a-z]+:", path) and not path.startswith("file:"):
        raise ValueError(f"not a mounted folder: {path}")
    return re.sub(r"^file:/*", "/", path)


SUPPLIERS = "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, round(s_acctbal, 2) AS latitude FROM supplier"


@query("csv_round_trip", SUPPLIERS)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as CSV parts, read with declared types."""
    path = shared_folder(spark, "csv")
    s = demo.table(spark, sf_dir, "supplier")
    tables.write_csv(s.select("s_suppkey", "s_name", F.col("s_acctbal").alias("latitude")), path)
    return shown(tables.read_csv(spark, path), 2)


@query("csv_missing_marks", "SELECT s_suppkey::VARCHAR AS s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'nan' WHEN s_suppkey % 3 = 0 THEN '-' ELSE s_suppkey::VARCHAR || '.5' END AS v FROM supplier")
def csv_missing_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is written as ``nan`` and NULL as the chosen mark."""
    path = shared_folder(spark, "csv")
    k = F.col("s_suppkey")
    value = F.when(k % 5 == 0, float("nan")).when(k % 3 != 0, k + 0.5)
    tables.write_csv(demo.table(spark, sf_dir, "supplier").select("s_suppkey", value.alias("v")), path, missing="-")
    return tables.read_csv(spark, path, text_only=True)


@query("csv_header", "SELECT * FROM (VALUES (0, 'n_nationkey'), (1, 'n_name'), (2, 'note; more')) t(position, name)")
def csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the column names of a delimited file."""
    path = shared_folder(spark, "csv")
    n = demo.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit("x").alias("note; more"))
    n.coalesce(1).write.option("header", True).option("sep", ";").csv(path)
    return spark.createDataFrame(list(enumerate(tables.header(spark, path, ";"))), "position int, name string")


RAGGED = "SELECT n_nationkey::VARCHAR AS k, {second} AS v, CASE WHEN n_nationkey % 3 = 2 THEN n_name END AS w FROM nation"


def _ragged(spark: SparkSession, sf_dir: str) -> str:
    """Lines of one, two, three or four fields under a header of three."""
    path = shared_folder(spark, "ragged")
    k = F.col("n_nationkey")
    rows = demo.table(spark, sf_dir, "nation").select(k, F.concat_ws("|", k.cast("string"), F.when(k % 3 >= 1, F.concat(F.lit("v"), k)), F.when(k % 3 == 2, F.col("n_name")), F.when(k % 6 == 5, "extra")).alias("line")).orderBy(k)
    store.write_bytes(spark, f"{path}/rows.csv", "\n".join(["k|v|w", *(r["line"] for r in rows.toLocalIterator())]).encode() + b"\n")
    return f"{path}/rows.csv"


@query("csv_short_rows", RAGGED.format(second="CASE WHEN n_nationkey % 3 >= 1 THEN 'v' || n_nationkey END"))
def csv_short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short rows are filled, fields beyond the header dropped."""
    return tables.read_csv(spark, _ragged(spark, sf_dir), "|", text_only=True)


@query("csv_fields_removed", "SELECT n_nationkey::VARCHAR || '|' || CASE WHEN n_nationkey % 3 = 2 THEN n_name ELSE '' END || CASE WHEN n_nationkey % 6 = 5 THEN '|extra' ELSE '' END AS line FROM nation UNION ALL SELECT 'k|w'")
def csv_fields_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column cut out of the fields: short rows are filled, fields beyond the header stay."""
    path = shared_folder(spark, "cut")
    tables.remove_fields(spark, _ragged(spark, sf_dir), path, ["v"], "|")
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.filter("line <> 'k|w'").unionByName(lines.filter("line = 'k|w'").limit(1))


@query("json_round_trip", "SELECT n_nationkey::VARCHAR AS key, n_name AS name, n_regionkey AS region FROM nation")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small JSON document in a folder of its own, and back."""
    path = f"{shared_folder(spark, 'json')}/deep/er/nations.json"
    store.write_json(spark, path, {str(r["n_nationkey"]): [r["n_name"], r["n_regionkey"]] for r in demo.table(spark, sf_dir, "nation").toLocalIterator()})
    return spark.createDataFrame([(k, *v) for k, v in store.read_json(spark, path).items()], "key string, name string, region long")


COORDINATES = "SELECT n_nationkey::VARCHAR AS zip, n_nationkey + 0.5 AS latitude, -n_nationkey - 0.25 AS longitude FROM nation"


@query("coordinate_map", f"SELECT zip, latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude FROM ({COORDINATES})")
def coordinate_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place map written as source text and read as a table."""
    path = f"{shared_folder(spark, 'map')}/map.py"
    rows = demo.table(spark, sf_dir, "nation").select("n_nationkey").toLocalIterator()
    store.write_bytes(spark, path, tables.mapping_text("places", {str(r[0]): {"latitude": r[0] + 0.5, "longitude": -r[0] - 0.25} for r in rows}).encode())
    return tables.coordinate_map(spark, tables.parse_json(store.read_bytes(spark, path).decode()))


@query("array_round_trip", f"WITH {CELLS} SELECT t_idx, f_idx, h_idx, round(value::DOUBLE, 4) AS value FROM long WHERE t_idx < 40 AND h_idx < 30")
def array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block of the tensor as one array file, and its cells read back."""
    path = f"{shared_folder(spark, 'array')}/x.npy"
    block = _cells(spark, sf_dir).filter("t_idx < 40 and h_idx < 30")
    tables.export_npy(block, path, (40, 2, 30), ["t_idx", "f_idx", "h_idx"])
    return shown(tables.import_npy(spark, path, ["t_idx", "f_idx", "h_idx"]), 4)


@query("tensor_file_round_trip", f"WITH {CELLS} SELECT t_idx, f_idx, h_idx, round(value::DOUBLE, 4) AS value FROM long WHERE t_idx < 20 AND h_idx < 30")
def tensor_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block of the tensor as a .pt file; what its storage, sizes and strides say."""
    folder = shared_folder(spark, "array")
    block = _cells(spark, sf_dir).filter("t_idx < 20 and h_idx < 30")
    tables.export_npy(block, f"{folder}/x.npy", (20, 2, 30), ["t_idx", "f_idx", "h_idx"])
    tables.export_tensor_file(spark, f"{folder}/x.npy", f"{folder}/x.pt")
    array = tables.import_tensor_file(spark, f"{folder}/x.pt")
    cells = [(*map(int, i), float(array[tuple(i)])) for i in np.argwhere(~np.isnan(array))]
    return shown(spark.createDataFrame(cells, "t_idx int, f_idx int, h_idx int, value float"), 4)


@query("sequence_layouts", f"WITH {CELLS}, n AS (SELECT floor(count(*) * 0.7::DOUBLE)::INT AS a, floor(count(*) * 0.2::DOUBLE)::INT AS b FROM t), w AS (SELECT count(*) AS w FROM p), s AS (SELECT CASE WHEN t_idx < a THEN 'train' WHEN t_idx < a + b THEN 'val' ELSE 'test' END AS split, CASE WHEN t_idx < a THEN t_idx WHEN t_idx < a + b THEN t_idx - a ELSE t_idx - a - b END AS t, (f_idx * w + h_idx)::INT AS i2, round(value::DOUBLE, 4) AS value FROM long, n, w) SELECT 'batch_first' AS layout, split, 0 AS i0, t AS i1, i2, value FROM s UNION ALL SELECT 'time_first', split, t, 0, i2, value FROM s")
def sequence_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observed cells in both layouts of a sequence input."""
    e = demo.table(spark, sf_dir, "events")
    times, people = e.select(F.date_trunc("hour", "ts")).distinct().count(), e.select("user_id").distinct().count()
    cells = tensor.split(_cells(spark, sf_dir), times, 0.7, 0.2, 0.1)
    parts = [tensor.sequence_cells(cells, people, first).select(F.lit(name).alias("layout"), "*") for name, first in (("batch_first", True), ("time_first", False))]
    return shown(parts[0].unionByName(parts[1]), 4)


@query("shapes_round_trip", "SELECT n_nationkey::VARCHAR AS GEOID20, n_name AS name, CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE 1 + n_nationkey % 2 END AS parts, CASE WHEN n_nationkey % 5 = 4 THEN 0.0 ELSE (1 + n_nationkey % 2) * (4.0 * n_nationkey + 2.0) END AS x_total FROM nation")
def shapes_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of one or two squares, or none, as a shapefile that several tasks read."""
    path = local(f"{shared_folder(spark, 'shapes')}/places.shp")
    square = lambda k: [(k, 0.0), (k, 1.0), (k + 1, 1.0), (k + 1, 0.0)]
    rows = [({"GEOID20": str(r["n_nationkey"]), "name": r["n_name"]}, [] if r["n_nationkey"] % 5 == 4 else [square(float(r["n_nationkey"]))] * (1 + r["n_nationkey"] % 2)) for r in demo.table(spark, sf_dir, "nation").toLocalIterator()]
    store.write_bytes(spark, path, b"")
    shapes.write_shapes(path, 5, rows)
    shapes.register(spark)
    got = spark.read.format("shapes").option("rows", "7").load(path)
    total = F.aggregate(F.flatten("parts"), F.lit(0.0), lambda a, p: a + p["x"])
    return got.select("GEOID20", "name", F.size("parts").alias("parts"), total.alias("x_total"))


@query("geometry_parts", "SELECT n_nationkey AS k, unnest(range(CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey % 4 END))::INT AS points_after FROM nation")
def geometry_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose geometry has points, one row a part; a part's points are counted off."""
    k = F.col("n_nationkey")
    part = lambda i: F.transform(F.sequence(F.lit(0), i), lambda j: F.struct(j.cast("double").alias("x"), j.cast("double").alias("y")))
    parts = F.when(k % 4 == 0, F.array(F.array().cast(shapes.PARTS[6:-1]))).otherwise(F.transform(F.sequence(F.lit(0), (k % 4 - 1).cast("int")), part))
    rows = project.with_geometry(demo.table(spark, sf_dir, "nation").select(k.alias("k"), parts.alias("parts")))
    return project.explode_parts(rows).select("k", (F.size("part") - 1).alias("points_after"))


def _feed_files(spark: SparkSession, sf_dir: str, folder: str, months: tuple[str, ...]) -> None:
    """Clicks and purchases of customers as monthly feed files, one a nation's remainder by 3; an empty one and a stranger beside."""
    rows = demo.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()
    for month, rest in (("mar", 0), ("jan", 1), ("sept", 2)):
        if month in months:
            out = io.StringIO()
            csv.writer(out, lineterminator="\n").writerows([("zip", "name"), *((r[0], r[1]) for r in rows if r[0] % 3 == rest)])
            store.write_bytes(spark, f"{folder}/{month}_2ndweek_air_quality_hourly_20260312_210107.csv", out.getvalue().encode())
    store.write_bytes(spark, f"{folder}/mar_3_air_quality_hourly_20260401_000000.csv", b"")
    store.write_bytes(spark, f"{folder}/notes.txt", b"zip,name\n")


@query("feed_ingestion", "WITH r AS (SELECT *, CASE n_nationkey % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS f FROM nation) SELECT 'rebuild append rebuild skip' AS actions, (row_number() OVER (ORDER BY f, n_nationkey) - 1)::BIGINT AS position, n_nationkey::VARCHAR AS zip, n_name AS name FROM r")
def feed_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files come in three steps, the last one late; the master table is in chronological order, each row once."""
    folder = shared_folder(spark, "feeds")
    actions = []
    for months in (("mar",), ("sept",), ("jan",), ()):
        _feed_files(spark, sf_dir, f"{folder}/in", months)
        files = feeds.find_files(spark, f"{folder}/in")["air_quality"]
        actions.append(feeds.ingest(spark, "air_quality", files, f"{folder}/master", f"{folder}/state/manifest.json").action)
    rows = feeds.master(spark, "air_quality", f"{folder}/master", f"{folder}/state/manifest.json").collect()
    return spark.createDataFrame([(" ".join(actions), k, r["zip"], r["name"]) for k, r in enumerate(rows)], "actions string, position long, zip string, name string")


NAMES = ("mar_2ndweek_air_quality_hourly_20260312_210107.csv", "Jan_10_WEATHER_x_20270101.CSV", "sept_3_air_quality_x.csv", "dec_1_weather_20251201_000000.csv", "dec_1_weather_.txt", "may_5_soil_.csv")


@query("feed_file_names", "SELECT * FROM (VALUES ('dec_1_weather_.txt', NULL, NULL, NULL), ('dec_1_weather_20251201_000000.csv', 'weather', 1, 12), ('Jan_10_WEATHER_x_20270101.CSV', 'weather', 0, 1), ('mar_2ndweek_air_quality_hourly_20260312_210107.csv', 'air_quality', 0, 3), ('may_5_soil_.csv', NULL, NULL, NULL), ('sept_3_air_quality_x.csv', 'air_quality', 1, 9)) t(name, kind, place, month)")
def feed_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of file names, by Python and by column, and their chronological places."""
    kinds = {n: feeds.kind_of(n) for n in NAMES}
    order = {k: sorted((n for n in NAMES if kinds[n] == k), key=feeds.order_key) for k in feeds.KINDS}
    rows = spark.createDataFrame([(n, order[k].index(n) if k else None, feeds.order_key(n)[0] if k else None) for n, k in kinds.items()], "name string, place int, month int")
    return rows.select("name", feeds.file_kind("name").alias("kind"), "place", "month")


@query("step_log", "SELECT * FROM (VALUES ('rows', 'suppliers', (SELECT count(*) FROM supplier)), ('rows', 'rich', (SELECT count(*) FROM supplier WHERE s_acctbal > 0)), ('read', 'supplier', 2), ('write', 'parquet', 1), ('sections', 'all', 2), ('seconds', 'load', 1)) t(kind, label, n)")
def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run's log holds: counts by observation, reads and writes, sections, timed steps; written as JSON and read back."""
    folder = shared_folder(spark, "log")
    log = report.StepLog()
    with log.step("load"):
        s = log.counted(demo.table(spark, sf_dir, "supplier"), "suppliers")
        log.add_read("supplier", 2)
    log.section("end")
    log.counted(s.filter("s_acctbal > 0"), "rich").write.parquet(f"{folder}/rich")
    log.add_write("parquet")
    store.write_json(spark, f"{folder}/summary.json", log.summary())
    got = store.read_json(spark, f"{folder}/summary.json")
    rows = [("rows", k, v) for k, v in got["rows"].items()] + [(k, label, n) for k, by in got["io"]["by_label"].items() for label, n in by.items()]
    rows += [("sections", "all", sum("section" in e for e in got["entries"])), ("seconds", "load", int(got["seconds"]["load"] >= 0))]
    return spark.createDataFrame(rows, "kind string, label string, n long")


@query("column_tools", "SELECT s_suppkey AS key, s_name AS title FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0")
def column_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns renamed and dropped, keys held, absent ones refused, rows without coordinates left out."""
    k = F.col("s_suppkey")
    s = demo.table(spark, sf_dir, "supplier").select(k, "s_name", F.when(k % 4 != 0, 1.0).alias("lat"), F.when(k % 5 == 0, float("nan")).otherwise(2.0).alias("lon"), F.lit(1).alias("extra"))
    project.require(s, ["lat", "lon"])
    for refused in (lambda: project.drop_columns(s, ["s_suppkey"], ["s_suppkey"]), lambda: project.drop_columns(s, ["absent"], strict=True), lambda: project.require(s, ["absent"])):
        try:
            refused()
        except ValueError:
            continue
        raise AssertionError("should have been refused")
    kept = project.drop_missing(project.drop_columns(s, ["extra", "absent"], ["s_suppkey"]), ["lat", "lon"])
    return project.rename(kept, {"s_suppkey": "key", "s_name": "title"})


@query("detected_headers", """SELECT * FROM (VALUES ('facility_id', 'TRIFID'), ('lat', 'LATITUDE83'), ('lon', 'LONGITUDE83'), ('amount', 'TOTAL RELEASE'), ('facility_name', 'FACILITY NAME'),
  ('chemical', 'CHEMICAL'), ('chemical amount', 'ON-SITE RELEASE TOTAL'), ('place', 'GEOID20'), ('trimmed', ' time '), ('direction 0', 'Wind_Direction_10m'), ('direction 1', 'wind_dir'), ('direction 2', 'heading'),
  ('list 0', 'a'), ('list 1', 'b'), ('union 0', 'x'), ('union 1', 'y'), ('union 2', 'z')) t(role, name)""")
def detected_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns the name helpers find."""
    facility = normalize.pick_columns(["YEAR", "TRIFID", "FACILITY NAME", "LATITUDE83", "LONGITUDE83", "TOTAL RELEASE"], normalize.FACILITY_HEADERS)
    chemical = normalize.pick_columns(["TRIFD", "CHEMICAL", "stack_lbs", "ON-SITE RELEASE TOTAL"], normalize.CHEMICAL_HEADERS)
    rows = [*facility.items(), ("chemical", chemical["chemical"]), ("chemical amount", chemical["amount"])]
    rows += [("place", normalize.require_column(["name", "GEOID20"], normalize.PLACE_HEADERS, "place")), ("trimmed", normalize.by_trimmed_name(["a", " time "], "time"))]
    for role, names in (("direction", normalize.direction_columns(["Wind_Direction_10m", "speed", "wind_dir", "heading"], ["heading", "absent"])), ("list", normalize.name_list(" a, ,b,")), ("union", normalize.union_names(["x", "y"], ["y", "z"]))):
        rows += [(f"{role} {k}", n) for k, n in enumerate(names)]
    return spark.createDataFrame(rows, "role string, name string")


@query("numeric_columns", "SELECT column_name AS name FROM (DESCRIBE lineitem) WHERE column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AND column_name <> 'l_orderkey'")
def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in normalize.numeric_columns(demo.table(spark, sf_dir, "lineitem"), ["l_orderkey"])], "name string")


@query("numeric_coercion", "WITH t AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_custkey::VARCHAR || '.5' WHEN 1 THEN ' ' || c_custkey || ' ' WHEN 2 THEN 'x' || c_custkey WHEN 3 THEN '' ELSE '-1e' || c_custkey % 7 END AS raw FROM customer) SELECT c_custkey, raw, try_cast(trim(raw) AS DOUBLE) AS value, CASE WHEN try_cast(trim(raw) AS DOUBLE) IS NOT NULL THEN least(greatest(try_cast(trim(raw) AS DOUBLE), 0), 1) END AS clipped FROM t")
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    raw = F.when(c % 5 == 0, F.concat(c.cast("string"), F.lit(".5"))).when(c % 5 == 1, F.concat(F.lit(" "), c.cast("string"), F.lit(" "))).when(c % 5 == 2, F.concat(F.lit("x"), c.cast("string"))).when(c % 5 == 3, "").otherwise(F.concat(F.lit("-1e"), (c % 7).cast("string")))
    rows = demo.table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select("c_custkey", "raw", normalize.number("raw").alias("value"), normalize.clip01(normalize.number("raw")).alias("clipped"))


TRI = """t AS (SELECT s.facility_id, 's' || s.facility_id AS facility_name, s.amount, count(DISTINCT chemical) AS chemical_count, round(sum(coalesce(c.amount, 0)), 2) AS released
  FROM facilities s LEFT JOIN chemicals c ON c.facility_id = s.facility_id GROUP BY ALL)"""


@query("facility_files", f"WITH {PLACES_SQL}, {TRI} SELECT facility_id::VARCHAR AS facility_id, facility_name, round(coalesce(amount, released, 0), 2) AS amount, chemical_count FROM t")
def facility_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities and chemicals as CSV files with usual headers, enriched from there."""
    folder = shared_folder(spark, "tri")
    f, c = demo.facilities(spark, sf_dir), demo.chemicals(spark, sf_dir)
    tables.write_csv(f.select(F.col("facility_id").alias("TRIFID"), F.concat(F.lit("s"), "facility_id").alias("FACILITY NAME"), (F.col("lat") / 1000).alias("LATITUDE83"), (F.col("lon") / 1000).alias("LONGITUDE83"), F.col("amount").alias("TOTAL RELEASE")), f"{folder}/facilities")
    tables.write_csv(c.select(F.col("facility_id").alias("TRIFD"), F.col("chemical").alias("CHEMICAL"), F.col("amount").alias("ON-SITE RELEASE TOTAL")), f"{folder}/chemicals")
    read = lambda name: tables.read_csv(spark, f"{folder}/{name}", text_only=True)
    out = impact.enrich_facilities(geography.facility_table(read("facilities")), geography.chemical_table(read("chemicals")), "chemicals")
    return shown(out.select("facility_id", "facility_name", "amount", "chemical_count"), 2)


@query(
    "static_scores_on_facts",
    PAIRS.format(zero="true")
    + f""", {ROADS_SQL}, {FEEDS_SQL},
rd AS (SELECT place, exp(-min(d) / 3000) AS s FROM road GROUP BY place),
fd AS (SELECT place, sum(severity * decay) AS raw FROM pairs GROUP BY place),
z AS (SELECT place, s / greatest(max(s) OVER (), 1e-12) AS r, coalesce(raw, 0) / greatest(max(coalesce(raw, 0)) OVER (), 1e-12) AS f FROM places JOIN rd USING (place) LEFT JOIN fd USING (place))
SELECT aq_id, zip, round(r, 6) AS road_impact_score, round(f, 6) AS facility_impact_score, CASE WHEN r IS NOT NULL THEN round(least(greatest(0.4 * r + 0.6 * f, 0), 1), 6) END AS overall_spatial_impact_score FROM aq LEFT JOIN z ON place = zip""",
)
def static_scores_on_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static scores looked up for every row of a feed; NULL where the place has none."""
    scores = impact.static_scores(demo.places(spark, sf_dir), _facilities(spark, sf_dir), demo.roads(spark, sf_dir), IMPACT)
    rows = impact.attach_static(demo.air(spark, sf_dir).select("aq_id", "zip"), scores, "zip")
    return shown(rows.select("aq_id", "zip", "road_impact_score", "facility_impact_score", "overall_spatial_impact_score"))


@query("coordinates_by_place", f"WITH {FEEDS_SQL}, m AS ({COORDINATES}), z AS (SELECT zip FROM aq GROUP BY zip) SELECT 'row' AS kind, aq.zip, aq_id, m.latitude::DOUBLE AS latitude, m.longitude::DOUBLE AS longitude FROM aq LEFT JOIN m USING (zip) UNION ALL SELECT 'missing', zip, NULL, NULL, NULL FROM z ANTI JOIN m USING (zip)")
def coordinates_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latitude and longitude from a place map, and the places it lacks."""
    rows = demo.air(spark, sf_dir).select("zip", "aq_id")
    keys = demo.table(spark, sf_dir, "nation").select("n_nationkey").toLocalIterator()
    places = tables.coordinate_map(spark, {str(r[0]): {"latitude": r[0] + 0.5, "longitude": -r[0] - 0.25} for r in keys})
    none = F.lit(None)
    missing = joins.missing_keys(rows, places, "zip").select(F.lit("missing").alias("kind"), "zip", none.cast("long").alias("aq_id"), none.cast("double").alias("latitude"), none.cast("double").alias("longitude"))
    return joins.lookup_join(rows, places, "zip").select(F.lit("row").alias("kind"), "zip", "aq_id", "latitude", "longitude").unionByName(missing)


@query(
    "hilbert_encoding",
    f"""WITH RECURSIVE {PLACES_SQL}, {FEEDS_SQL},
here AS (SELECT place, x, y FROM places WHERE place IN (SELECT zip FROM aq)),
c AS (SELECT place, x AS cx, y AS cy, round_even((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) * 63, 0)::BIGINT AS gx, round_even((y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ()) * 63, 0)::BIGINT AS gy FROM here),
h AS (SELECT place, cx, cy, gx, gy, gx AS x, gy AS y, 32::BIGINT AS s, 0::BIGINT AS d FROM c
  UNION ALL
  SELECT place, cx, cy, gx, gy,
    CASE WHEN (y & s) > 0 THEN x WHEN (x & s) > 0 THEN 63 - y ELSE y END,
    CASE WHEN (y & s) > 0 THEN y WHEN (x & s) > 0 THEN 63 - x ELSE x END,
    s // 2, d + s * s * xor(3 * ((x & s) > 0)::BIGINT, ((y & s) > 0)::BIGINT)
  FROM h WHERE s > 0),
m AS (SELECT place, cx, cy, gx, gy, d, row_number() OVER (ORDER BY d, place) - 1 AS p FROM h WHERE s = 0)
SELECT aq_id, zip, cx::DOUBLE AS centroid_x_m, cy::DOUBLE AS centroid_y_m, gx::INT AS grid_x, gy::INT AS grid_y, d AS hilbert_index, p::INT AS hilbert_position FROM aq LEFT JOIN m ON place = zip""",
)
def hilbert_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a feed with the Hilbert index and position of their place."""
    rows = demo.air(spark, sf_dir).select("aq_id", "zip")
    return shown(geography.hilbert_encode(rows, demo.places(spark, sf_dir), 6)[0].select("aq_id", "zip", "centroid_x_m", "centroid_y_m", "grid_x", "grid_y", "hilbert_index", "hilbert_position"), 3)


SCORED = (
    PAIRS.format(zero="dist_m > 0")
    + f""", {ROADS_SQL}, {PAIRED.removeprefix("WITH ")},
q AS (SELECT m.*, wind_speed_10m AS s1, wind_speed_100m AS s2, radians(wind_direction_10m) AS a1, radians(wind_direction_100m) AS a2 FROM m),
v AS (SELECT *, s1 * cos(a1) AS rx, s1 * sin(a1) AS ry, 0.3 * s1 * cos(a1) + 0.7 * s2 * cos(a2) AS fx, 0.3 * s1 * sin(a1) + 0.7 * s2 * sin(a2) AS fy FROM q),
rs AS (SELECT place AS zip, list({{'k': exp(-d / 3000), 'x': dx / d, 'y': dy / d}}) AS l FROM road WHERE d <= 3000 AND d > 0 GROUP BY place),
fs AS (SELECT place AS zip, list({{'k': severity * decay, 'x': dir_x, 'y': dir_y}}) AS l FROM pairs GROUP BY place),
known AS (SELECT place AS zip FROM places)"""
)


@query(
    "feature_table_scored",
    SCORED
    + f"""
SELECT v.zip, {TIME.replace("strftime(time", "strftime(v.time")}, aq_id, round(us_aqi, 6) AS us_aqi, round(latitude, 6) AS latitude, wx_id, round(wind_speed_10m, 6) AS wind_speed_10m, round(wind_speed_100m, 6) AS wind_speed_100m, {SIN_COS}, {CAL},
  CASE WHEN known.zip IS NULL OR rs.l IS NULL THEN 0.0 WHEN rx IS NULL THEN NULL ELSE round(list_sum(list_transform(rs.l, lambda p: p.k * greatest(rx * p.x + ry * p.y, 0))), 6) + 0.0 END AS road_impact_score,
  CASE WHEN known.zip IS NULL OR fs.l IS NULL THEN 0.0 WHEN fx IS NULL THEN NULL ELSE round(list_sum(list_transform(fs.l, lambda p: p.k * greatest(fx * p.x + fy * p.y, 0))), 6) + 0.0 END AS facility_impact_score,
  round(lag(us_aqi, 1) OVER w, 6) + 0.0 AS us_aqi_past_1
FROM v LEFT JOIN known USING (zip) LEFT JOIN rs USING (zip) LEFT JOIN fs USING (zip) WINDOW w AS (PARTITION BY v.zip ORDER BY v.time, aq_id NULLS FIRST, wx_id NULLS FIRST)""",
)
def feature_table_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole main path: columns dropped, feeds paired, wind-driven scores, lags, pruning by content.

    A column of one value and one that almost never differs are added; both are pruned.
    """
    config = pipelines.FeatureConfig(
        lagged=("us_aqi",), lags=1, left_drop=("pm2_5",), cardinality_threshold=3, variance_threshold=0.03, impact=IMPACT,
        keep_variance=(*pipelines.KEEP_VARIANCE, "us_aqi", "latitude", "aq_id", "wx_id", "month", "month_sin", "month_cos", "us_aqi_past_1", "wind_speed_100m"),
    )
    wind = demo.weather(spark, sf_dir).withColumns({"station": F.lit("north"), "spike": F.when(F.col("wx_id") <= 20, 1.0).otherwise(F.col("wind_speed_10m") * 1e-9)})
    out, found = pipelines.stream_features(demo.air(spark, sf_dir), wind, ["aq_id"], ["wx_id"], config, _lookup(spark, sf_dir))
    if set(found.notes["low_cardinality"].removed) != {"station"} or "spike" not in found.notes["low_variance"].removed:
        raise AssertionError(found.notes)
    return shown(out)


PRICES = """c AS (SELECT avg(l_quantity) AS m1, avg(l_extendedprice) AS m2, avg(l_discount) AS m3, avg(l_tax) AS m4 FROM lineitem),
k AS (SELECT """ + ", ".join(f"covar_pop({a}, {b}) AS k{i}{j}" for i, a in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), 1) for j, b in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), 1)) + """ FROM lineitem),
p AS (SELECT 0 AS n, 0.0::DOUBLE AS a, 1.0::DOUBLE AS b, 0.0::DOUBLE AS c, 0.0::DOUBLE AS d
  UNION ALL SELECT n + 1, w / l, x / l, y / l, z / l FROM (SELECT n, w, x, y, z, sqrt(w * w + x * x + y * y + z * z) AS l FROM (
    SELECT n, """ + ", ".join(f"k{i}1 * a + k{i}2 * b + k{i}3 * c + k{i}4 * d AS {v}" for i, v in enumerate("wxyz", 1)) + """ FROM p, k WHERE n < 12)))"""


@query("principal_components", f"WITH RECURSIVE {PRICES} SELECT l_orderkey, l_linenumber, round(abs(a * (l_quantity - m1) + b * (l_extendedprice - m2) + p.c * (l_discount - m3) + d * (l_tax - m4)), 3) AS pc1, round(abs(a), 9) AS loading_quantity, round(abs(b), 9) AS loading_price FROM lineitem, c, p WHERE n = 12")
def principal_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component that keeps 95 % of the variance, without its arbitrary sign; SQL finds it by power iteration."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = demo.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *names)
    out, about = ml.principal_components(rows, names, 0.95, ["l_orderkey", "l_linenumber"])
    load = about.loadings["PC1"]
    return out.select("l_orderkey", "l_linenumber", F.round(F.abs("PC1"), 3).alias("pc1"), F.round(F.lit(abs(load["l_quantity"])), 9).alias("loading_quantity"), F.round(F.lit(abs(load["l_extendedprice"])), 9).alias("loading_price"))


def _stream(spark: SparkSession, sf_dir: str, folder: str, columns: str) -> tuple[DataFrame, T.StructType]:
    """Events as CSV files of a folder, and a stream of them."""
    e = demo.table(spark, sf_dir, "events").selectExpr(*columns.split(", "))
    e.repartition(3, e.columns[0]).write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(folder)
    return streams.feed_stream(spark, folder, e.schema, files_per_trigger=1), e.schema


@query("stream_pickup", "SELECT event_id, user_id, value FROM events")
def stream_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files of a folder appended to a table, each once, though the pickup runs twice."""
    folder = shared_folder(spark, "stream")
    for _ in range(2):
        if not store.exists(spark, f"{folder}/in"):
            stream, schema = _stream(spark, sf_dir, f"{folder}/in", "event_id, user_id, value")
        else:
            stream = streams.feed_stream(spark, f"{folder}/in", schema)
        streams.append_available(stream.drop("source_file", "arrival"), f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/table")


@query("stream_upsert", "SELECT user_id, hour(ts)::INT AS hour, max(event_id) % 1000 AS late, count(*) > 0 AS seen FROM events WHERE event_id % 2 = 1 GROUP BY ALL")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of files merged by key; the later batch's rows, in file order, win."""
    folder = shared_folder(spark, "upsert")
    e = demo.table(spark, sf_dir, "events").filter("event_id % 2 = 1").select("user_id", F.hour("ts").alias("hour"), "event_id")
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("hour", T.IntegerType()), T.StructField("late", T.LongType()), T.StructField("seen", T.BooleanType())])
    # the first batch has every key with a wrong value, the second each event in order
    first = e.select("user_id", "hour", F.lit(-1).cast("long").alias("late"), F.lit(False).alias("seen")).distinct()
    second = e.orderBy("event_id").coalesce(1).select("user_id", "hour", (F.col("event_id") % 1000).alias("late"), F.lit(True).alias("seen"))
    for rows in (first, second):
        rows.write.mode("append").option("header", True).csv(f"{folder}/in")
        streams.upsert_available(streams.feed_stream(spark, f"{folder}/in", schema).drop("source_file"), f"{folder}/table", f"{folder}/checkpoint", ["user_id", "hour"], "hour").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("user_id", "hour", "late", "seen")


@query("stream_lags", "SELECT event_id, value, lag(value, 1) OVER w AS value_past_1, lag(value, 2) OVER w AS value_past_2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def stream_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags that a keyed state carries from batch to batch; files hold ascending ranges of event_id."""
    folder = shared_folder(spark, "lags")
    e = demo.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    least, most = e.agg(F.min("event_id"), F.max("event_id")).first()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for k in range(2):
        edge = lambda i: least + (most + 1 - least) * i // 2
        e.filter((F.col("event_id") >= edge(k)) & (F.col("event_id") < edge(k + 1))).write.mode("append").option("header", True).csv(f"{folder}/in")
        stream = streams.feed_stream(spark, f"{folder}/in", e.schema).drop("source_file", "arrival")
        lagged = streams.stream_lags(stream, "user_id", "event_id", ["value"], 2)
        streams.append_available(lagged, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    out = spark.read.schema(lagged.schema).parquet(f"{folder}/table")
    nothing = F.lit(None).cast("double")
    return out.select("event_id", "value", *(F.nanvl(c, nothing).alias(c) for c in ("value_past_1", "value_past_2")))


@query("stream_statistics", "SELECT 'value' AS \"column\", count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 4) AS variance, min(value) AS least, max(value) AS most, (SELECT count(DISTINCT value) FROM events) AS distinct_values FROM events")
def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statistics and exact running distinct counts, as they stand after all files."""
    folder = shared_folder(spark, "statistics")
    stream, _ = _stream(spark, sf_dir, f"{folder}/in", "value, event_id")
    got = {}
    for name, df in (("numbers", streams.running_statistics(stream, ["value"])), ("values", streams.running_values(stream, ["value"]))):
        table = f"{name}_{uuid.uuid4().hex[:8]}"
        df.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/{name}").foreachBatch(lambda batch, _, to=f"{folder}/{table}": batch.write.mode("overwrite").parquet(to)).trigger(availableNow=True).start().awaitTermination()
        got[name] = spark.read.parquet(f"{folder}/{table}")
    n = got["values"].groupBy("column").agg(F.count("*").alias("distinct_values"))
    numbers = got["numbers"].select(F.lit("value").alias("column"), F.col("n_value").alias("n"), F.round("mean_value", 6).alias("mean"), F.round("variance_value", 4).alias("variance"), F.col("min_value").alias("least"), F.col("max_value").alias("most"))
    return numbers.join(n, "column")


@query("stream_stream_join", "WITH c AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'), v AS (SELECT user_id, ts, event_id FROM events WHERE event_id % 3 = 0) SELECT c.user_id, c.event_id AS a, v.event_id AS b FROM c JOIN v USING (user_id, ts)")
def stream_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams joined on key and time under watermarks: the pairs, which don't depend on when a side is given up."""
    folder = shared_folder(spark, "join")
    e = demo.table(spark, sf_dir, "events")
    sides = []
    for name, rows in (("a", e.filter("event_type = 'click'")), ("b", e.filter("event_id % 3 = 0"))):
        part = rows.select("user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias(name))
        part.write.parquet(f"{folder}/{name}")
        sides.append(spark.readStream.schema(part.schema).parquet(f"{folder}/{name}"))
    joined = streams.stream_join(*sides, "user_id", "ts", "1000 days")
    streams.append_available(joined, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/table").filter("a is not null and b is not null").select("user_id", "a", "b")


@query("command_line_merge", f"{PAIRED} SELECT zip, {TIME}, aq_id::VARCHAR AS aq_id, wx_id::VARCHAR AS wx_id FROM m")
def command_line_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command line's merge of two CSV files."""
    folder = shared_folder(spark, "merge")
    for name, df, key in (("l", demo.air(spark, sf_dir), "aq_id"), ("r", demo.weather(spark, sf_dir), "wx_id")):
        tables.write_csv(shown(df.select("zip", "time", key)).orderBy(key), f"{folder}/{name}", single_file=True)
    cli.main(["merge", "--left", f"{folder}/l", "--right", f"{folder}/r", "--output", f"{folder}/out", "--missing", "-"], spark)
    out = spark.read.option("header", True).option("nullValue", "-").schema(tables.text_schema(["zip", "time", "aq_id", "wx_id"])).csv(f"{folder}/out")
    return out.select("zip", "time", "aq_id", "wx_id")

