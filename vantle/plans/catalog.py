"""The registered queries and their DuckDB oracles.

Times leave as text and doubles rounded, so both engines give the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features, normalize, spatial
from ..operators import impact, joins, lags, project, quality, stats, tensor
from ..session import written
from . import demo, pipelines
from .demo import FEEDS_SQL, PLACES_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEYS = ["zip", "time"]


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Timestamps as text, doubles rounded, NaN as NULL."""
    out = {}
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            out[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("double", "float"):
            out[name] = F.round(F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")), digits) + F.lit(0.0)
    return df.withColumns(out) if out else df


TIME = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time"
CAL = """month(time)::INT AS month, round(sin(2 * pi() * month(time) / 12), 6) + 0.0 AS month_sin, round(cos(2 * pi() * month(time) / 12), 6) + 0.0 AS month_cos,
  day(time)::INT AS day, hour(time)::INT AS hour, round(sin(2 * pi() * hour(time) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(time) / 24), 6) + 0.0 AS hour_cos,
  (isodow(time) - 1)::INT AS day_of_week, round(sin(2 * pi() * (isodow(time) - 1) / 7), 6) + 0.0 AS day_of_week_sin, round(cos(2 * pi() * (isodow(time) - 1) / 7), 6) + 0.0 AS day_of_week_cos,
  dayofyear(time)::INT AS day_of_year, (isodow(time) >= 6)::INT AS is_weekend"""

PAIRED = f"""WITH {FEEDS_SQL},
a AS (SELECT *, row_number() OVER (PARTITION BY zip, time ORDER BY aq_id) AS rn FROM aq),
b AS (SELECT *, row_number() OVER (PARTITION BY zip, time ORDER BY wx_id) AS rn FROM wx),
m AS (SELECT coalesce(a.zip, b.zip) AS zip, coalesce(a.time, b.time) AS time, a.aq_id, a.us_aqi, a.pm2_5, b.latitude AS latitude, a.latitude AS left_latitude,
             b.wx_id, b.wind_speed_10m, b.wind_speed_100m, b.wind_direction_10m, b.wind_direction_100m
      FROM a FULL OUTER JOIN b ON a.zip = b.zip AND a.time = b.time AND a.rn = b.rn)"""
LAGS = ", ".join(f"round(lag({c}, {k}) OVER w, 6) + 0.0 AS {c}_past_{k}" for c in ("us_aqi", "wind_speed_10m") for k in (1, 2, 3))
SIN_COS = ", ".join(f"round({f}(radians(wind_direction_{h})), 6) + 0.0 AS wind_direction_{h}_{f}" for h in ("10m", "100m") for f in ("sin", "cos"))


@query(
    "feature_table",
    f"""{PAIRED}
SELECT zip, {TIME}, aq_id, round(us_aqi, 6) AS us_aqi, round(pm2_5, 6) AS pm2_5, round(latitude, 6) AS latitude, wx_id,
  round(wind_speed_10m, 6) AS wind_speed_10m, round(wind_speed_100m, 6) AS wind_speed_100m, {SIN_COS}, {CAL},
  0.0::DOUBLE AS road_impact_score, 0.0::DOUBLE AS facility_impact_score, {LAGS}
FROM m WINDOW w AS (PARTITION BY zip ORDER BY m.time, aq_id NULLS FIRST, wx_id NULLS FIRST)""",
)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds to one feature table: pairing join, directions, calendar, positional lags."""
    config = pipelines.FeatureConfig(lagged=("us_aqi", "wind_speed_10m"), lags=3)
    out, _ = pipelines.stream_features(demo.air(spark, sf_dir), demo.weather(spark, sf_dir), ["aq_id"], ["wx_id"], config)
    return shown(out)


def _paired(spark: SparkSession, sf_dir: str, how: str = "full_outer", overlap: str = "right") -> DataFrame:
    return joins.pairing_join(demo.air(spark, sf_dir), demo.weather(spark, sf_dir), KEYS, ["aq_id"], ["wx_id"], how, overlap, "side")


SIDE = "CASE WHEN aq_id IS NOT NULL AND wx_id IS NOT NULL THEN 'both' WHEN aq_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side"


@query("pairing_join_right_wins", f"{PAIRED} SELECT zip, {TIME}, aq_id, round(latitude, 6) AS latitude, wx_id, {SIDE} FROM m")
def pairing_join_right_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_paired(spark, sf_dir).select(*KEYS, "aq_id", "latitude", "wx_id", "side"))


@query("pairing_join_coalesce", f"{PAIRED} SELECT zip, {TIME}, aq_id, round(coalesce(left_latitude, latitude), 6) AS latitude, wx_id, {SIDE} FROM m")
def pairing_join_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_paired(spark, sf_dir, overlap="coalesce").select(*KEYS, "aq_id", "latitude", "wx_id", "side"))


@query("pairing_join_inner", f"{PAIRED} SELECT zip, {TIME}, aq_id, round(left_latitude, 6) AS latitude, wx_id FROM m WHERE aq_id IS NOT NULL AND wx_id IS NOT NULL")
def pairing_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_paired(spark, sf_dir, "inner", "left").select(*KEYS, "aq_id", "latitude", "wx_id"))


@query("match_counts", f"{PAIRED}, s AS (SELECT {SIDE} FROM m) SELECT count(*) FILTER (side = 'both') AS matched_rows, count(*) FILTER (side = 'left_only') AS left_only_rows, count(*) FILTER (side = 'right_only') AS right_only_rows, count(*) AS rows_written FROM s")
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.match_counts(_paired(spark, sf_dir), "side")


@query("left_wins_join", f"WITH {FEEDS_SQL} SELECT zip, {TIME}, aq_id, aq.latitude, wx_id, round(wind_speed_10m, 6) AS wind_speed_10m FROM aq JOIN wx USING (zip, time)")
def left_wins_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.left_wins_join(demo.air(spark, sf_dir), demo.weather(spark, sf_dir), KEYS)
    return shown(out.select(*KEYS, "aq_id", "latitude", "wx_id", "wind_speed_10m"))


@query(
    "timestep_merge",
    f"{PAIRED} SELECT zip, {TIME}, aq_id, round(us_aqi, 6) AS us_aqi, wx_id, round(wind_speed_10m, 6) AS wind_speed_10m FROM m",
)
def timestep_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = demo.air(spark, sf_dir).select(*KEYS, "aq_id", "us_aqi"), demo.weather(spark, sf_dir).select(*KEYS, "wx_id", "wind_speed_10m")
    return shown(pipelines.merge_two(a, b, KEYS, "time", ["aq_id"], ["wx_id"]))


@query("timestep_ids", f"WITH {FEEDS_SQL}, t AS (SELECT time FROM aq UNION SELECT time FROM wx) SELECT {TIME}, row_number() OVER (ORDER BY t.time)::INT AS timestep FROM t")
def timestep_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(joins.timestep_ids(demo.air(spark, sf_dir), demo.weather(spark, sf_dir), "time"))


@query("semi_join_members", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def semi_join_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = demo.table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return project.keep_members(demo.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), keys, "c_nationkey")


@query("anti_join_missing", "SELECT DISTINCT p_partkey AS l_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def anti_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = demo.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    return joins.missing_keys(parts, demo.table(spark, sf_dir, "lineitem").filter("l_quantity > 45"), "l_partkey")


@query("lookup_join_default", "SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) ON o_custkey = c_custkey")
def lookup_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = demo.table(spark, sf_dir, "customer").filter("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    out = joins.lookup_join(demo.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey", {"c_acctbal": 0.0})
    return out.select("o_orderkey", "c_acctbal")


ENRICHED = f"""WITH {PLACES_SQL},
per AS (SELECT facility_id, sum(coalesce(amount, 0)) AS total, count(DISTINCT chemical) AS n FROM chemicals GROUP BY facility_id),
fac AS (SELECT f.facility_id, sx, sy, coalesce(f.amount, 0.0) AS amount, coalesce(n, 0) AS chemical_count, coalesce(f.amount, total, 0.0) AS filled FROM facilities f LEFT JOIN per USING (facility_id))"""
PAIRS = f"""{ENRICHED},
near AS (SELECT place, facility_id, x - sx AS dx, y - sy AS dy, sqrt((x - sx) ** 2 + (y - sy) ** 2) AS dist_m, amount, chemical_count FROM places, fac),
inr AS (SELECT * FROM near WHERE dist_m <= 6000),
sc AS (SELECT CASE WHEN q IS NULL OR q <= 0 THEN greatest(coalesce(mx, 1.0), 1.0) ELSE q END AS amount_scale, greatest(coalesce(mc, 1), 1) AS count_scale
       FROM (SELECT quantile_cont(amount, 0.95) AS q, max(amount) AS mx, max(chemical_count) AS mc FROM inr WHERE {{zero}})),
pairs AS (SELECT place, facility_id, dist_m, dx / dist_m AS dir_x, dy / dist_m AS dir_y,
                 0.7 * least(greatest(amount / amount_scale, 0), 1) + 0.3 * least(greatest(chemical_count / count_scale, 0), 1) AS severity, exp(-dist_m / 6000) AS decay
          FROM inr, sc WHERE {{zero}})"""


def _facilities(spark: SparkSession, sf_dir: str, fallback: str = "none") -> DataFrame:
    return impact.enrich_facilities(demo.facilities(spark, sf_dir), demo.chemicals(spark, sf_dir), fallback)


@query("facility_enrichment", f"{ENRICHED} SELECT facility_id, round(amount, 4) AS amount, round(filled, 4) AS amount_filled, chemical_count FROM fac")
def facility_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _facilities(spark, sf_dir).select("facility_id", "amount", "chemical_count")
    with_sum = _facilities(spark, sf_dir, "chemicals").select("facility_id", F.col("amount").alias("amount_filled"))
    return shown(plain.join(with_sum, "facility_id"), 4)


@query("facility_pairs", PAIRS.format(zero="dist_m > 0") + " SELECT place, facility_id, round(dist_m, 6) AS dist_m, round(dir_x, 6) + 0.0 AS dir_x, round(dir_y, 6) + 0.0 AS dir_y, round(severity, 6) AS severity, round(decay, 6) AS decay FROM pairs")
def facility_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = impact.facility_pairs(demo.places(spark, sf_dir), _facilities(spark, sf_dir), 6000.0)
    return shown(out.select("place", "facility_id", "dist_m", "dir_x", "dir_y", "severity", "decay"))


@query("radius_join_count", f"WITH {PLACES_SQL} SELECT count(*) AS pairs, round(sum(d), 3) AS total FROM (SELECT sqrt((x - sx) ** 2 + (y - sy) ** 2) AS d FROM places, facilities) WHERE d <= 2500")
def radius_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.distance_join(demo.places(spark, sf_dir), demo.facilities(spark, sf_dir), 2500.0)
    return out.agg(F.count("*").alias("pairs"), F.round(F.sum("dist_m"), 3).alias("total"))


ROADS_SQL = """
seg AS (SELECT r_regionkey AS road_id, r_regionkey * 5000.0 AS ax, 0.0 AS ay, r_regionkey * 5000.0 + 700 AS bx, 9000.0 AS cy FROM region
        UNION ALL SELECT r_regionkey, r_regionkey * 5000.0 + 700, 9000.0, r_regionkey * 4000.0, 24000.0 FROM region),
tt AS (SELECT place, x, y, road_id, ax, ay, bx - ax AS ux, cy - ay AS uy,
             least(1.0, greatest(0.0, ((x - ax) * (bx - ax) + (y - ay) * (cy - ay)) / ((bx - ax) ** 2 + (cy - ay) ** 2))) AS t FROM places, seg),
np AS (SELECT place, x, y, road_id, ax + t * ux AS nx, ay + t * uy AS ny FROM tt),
nd AS (SELECT *, sqrt((x - nx) ** 2 + (y - ny) ** 2) AS d FROM np),
road AS (SELECT place, road_id, min(d) AS d, arg_min(x - nx, d) AS dx, arg_min(y - ny, d) AS dy FROM nd GROUP BY place, road_id)"""


@query("road_pairs", f"WITH {PLACES_SQL}, {ROADS_SQL} SELECT place, road_id, round(d, 6) AS dist_m, round(dx / d, 6) + 0.0 AS dir_x, round(dy / d, 6) + 0.0 AS dir_y, round(exp(-d / 3000), 6) AS decay FROM road WHERE d <= 3000 AND d > 0")
def road_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = impact.road_pairs(demo.places(spark, sf_dir), demo.roads(spark, sf_dir), 3000.0)
    return shown(out.select("place", "road_id", "dist_m", "dir_x", "dir_y", "decay"))


IMPACT = impact.ImpactConfig(road_radius=3000.0, facility_radius=6000.0)


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = demo.places(spark, sf_dir)
    return impact.pair_lookup(p, impact.facility_pairs(p, _facilities(spark, sf_dir), 6000.0), impact.road_pairs(p, demo.roads(spark, sf_dir), 3000.0))


@query(
    "wind_scores",
    PAIRS.format(zero="dist_m > 0")
    + f""", {ROADS_SQL}, {FEEDS_SQL},
w AS (SELECT wx_id, (wx_id % 40)::VARCHAR AS place, wind_speed_10m AS s1, wind_speed_100m AS s2, radians(wind_direction_10m) AS a1, radians(wind_direction_100m) AS a2 FROM wx),
v AS (SELECT wx_id, place, s1 * cos(a1) AS rx, s1 * sin(a1) AS ry, 0.3 * s1 * cos(a1) + 0.7 * s2 * cos(a2) AS fx, 0.3 * s1 * sin(a1) + 0.7 * s2 * sin(a2) AS fy FROM w),
rs AS (SELECT wx_id, sum(exp(-d / 3000) * greatest(rx * dx / d + ry * dy / d, 0)) AS s FROM v JOIN road USING (place) WHERE d <= 3000 AND d > 0 GROUP BY wx_id),
fs AS (SELECT wx_id, sum(severity * decay * greatest(fx * dir_x + fy * dir_y, 0)) AS s FROM v JOIN pairs USING (place) GROUP BY wx_id)
SELECT v.wx_id, v.place, round(coalesce(rs.s, 0), 6) + 0.0 AS road_impact_score, round(coalesce(fs.s, 0), 6) + 0.0 AS facility_impact_score
FROM v LEFT JOIN rs USING (wx_id) LEFT JOIN fs USING (wx_id)""",
)
def wind_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_directions(demo.weather(spark, sf_dir)).withColumn("place", (F.col("wx_id") % 40).cast("string"))
    return shown(impact.wind_scores(rows, _lookup(spark, sf_dir), "place", IMPACT).select("wx_id", "place", "road_impact_score", "facility_impact_score"))


@query("pair_lookup_counts", PAIRS.format(zero="dist_m > 0") + f", {ROADS_SQL} SELECT place, (SELECT count(DISTINCT facility_id) FROM pairs p WHERE p.place = places.place) AS facility_count_nearby, (SELECT count(DISTINCT road_id) FROM road r WHERE r.place = places.place AND d <= 3000 AND d > 0) AS road_count_nearby FROM places")
def pair_lookup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir).select("place", "facility_count_nearby", "road_count_nearby")


@query(
    "pair_lookup",
    PAIRS.format(zero="dist_m > 0")
    + f""", {ROADS_SQL} SELECT place, 'facility' AS kind, facility_id AS source, round(dir_x, 6) + 0.0 AS dir_x, round(dir_y, 6) + 0.0 AS dir_y, round(decay, 6) AS decay, round(severity, 6) AS severity FROM pairs
UNION ALL SELECT place, 'road', road_id, round(dx / d, 6) + 0.0, round(dy / d, 6) + 0.0, round(exp(-d / 3000), 6), NULL FROM road WHERE d <= 3000 AND d > 0""",
)
def pair_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that the lookup's arrays hold, one row each."""
    lookup = written(_lookup(spark, sf_dir), "lookup")
    each = lambda pairs, kind, source, severity: lookup.select("place", F.explode(pairs).alias("p")).select("place", F.lit(kind).alias("kind"), F.col(f"p.{source}").cast("long").alias("source"), "p.dir_x", "p.dir_y", "p.decay", severity.alias("severity"))
    return shown(each("facility_pairs", "facility", "facility_id", F.col("p.severity")).unionByName(each("road_pairs", "road", "road_id", F.lit(None).cast("double"))))


@query(
    "static_scores",
    PAIRS.format(zero="true")
    + f""", {ROADS_SQL},
rd AS (SELECT place, min(d) AS d, exp(-min(d) / 3000) AS s FROM road GROUP BY place),
fd AS (SELECT place, sum(severity * decay) AS raw, count(DISTINCT facility_id) AS n FROM pairs GROUP BY place),
j AS (SELECT place, d, s, coalesce(raw, 0) AS raw, coalesce(n, 0) AS n FROM places JOIN rd USING (place) LEFT JOIN fd USING (place)),
z AS (SELECT *, s / greatest(max(s) OVER (), 1e-12) AS r, raw / greatest(max(raw) OVER (), 1e-12) AS f FROM j)
SELECT place, round(d, 6) + 0.0 AS road_distance_m, round(r, 6) AS road_impact_score, n AS facility_count_nearby, round(f, 6) AS facility_impact_score,
       round(least(greatest(0.4 * r + 0.6 * f, 0), 1), 6) AS overall_spatial_impact_score FROM z""",
)
def static_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(impact.static_scores(demo.places(spark, sf_dir), _facilities(spark, sf_dir), demo.roads(spark, sf_dir), IMPACT))


@query(
    "batch_features",
    f"""WITH {FEEDS_SQL}, j AS (SELECT zip, time, aq_id, us_aqi, pm2_5, aq.latitude, wx_id, wind_speed_10m, wind_speed_100m, wind_direction_10m, wind_direction_100m
  FROM (SELECT * REPLACE (lpad(zip, 5, '0') AS zip) FROM aq) aq JOIN (SELECT * REPLACE (lpad(zip, 5, '0') AS zip) FROM wx) wx USING (zip, time))
SELECT zip, {TIME}, aq_id, round(us_aqi, 6) AS us_aqi, round(pm2_5, 6) AS pm2_5, round(latitude, 6) AS latitude, wx_id, round(wind_speed_10m, 6) AS wind_speed_10m,
  round(wind_speed_100m, 6) AS wind_speed_100m, {SIN_COS}, year(time)::INT AS year, {CAL},
  {", ".join(f"round(lag(pm2_5, {k}) OVER w, 6) + 0.0 AS pm2_5_past_{k}" for k in (1, 2))}
FROM j WINDOW w AS (PARTITION BY zip ORDER BY j.time, aq_id, wx_id)""",
)
def batch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = lambda df: df.withColumn("zip", normalize.zip_padded("zip"))
    config = pipelines.FeatureConfig(lagged=("pm2_5",), lags=2)
    out, _, _ = pipelines.batch_features(padded(demo.air(spark, sf_dir)), padded(demo.weather(spark, sf_dir)), ["aq_id", "wx_id"], config)
    return shown(out)


@query(
    "normalize_times",
    """WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-06:00' WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z'
  WHEN 2 THEN 'bad' WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw, ts FROM events)
SELECT event_id, raw, CASE event_id % 5 WHEN 2 THEN NULL WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M') || ':00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS standard,
  CASE event_id % 5 WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE raw END AS stripped FROM t""",
)
def normalize_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda p: F.date_format("ts", p)
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.concat(text("yyyy-MM-dd'T'HH:mm:ss"), F.lit("-06:00"))).when(k == 1, F.concat(text("yyyy-MM-dd HH:mm:ss"), F.lit("Z"))).when(k == 2, "bad").when(k == 3, text("yyyy-MM-dd HH:mm")).otherwise(text("yyyy-MM-dd HH:mm:ss"))
    rows = demo.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", "raw", normalize.standard_time("raw").alias("standard"), normalize.strip_after_seconds("raw").alias("stripped"))


@query(
    "normalize_zips",
    """WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN (70000 + c_custkey) || '-1234' WHEN 2 THEN c_custkey || '.0' ELSE ' ' || (77000 + c_custkey) END AS raw FROM customer)
SELECT c_custkey, raw, nullif(regexp_extract(raw, '(\\d{5})', 1), '') AS first_digits,
  CASE WHEN length(split_part(trim(raw), '.', 1)) >= 5 THEN split_part(trim(raw), '.', 1) ELSE lpad(split_part(trim(raw), '.', 1), 5, '0') END AS padded,
  CASE WHEN length(regexp_replace(raw, '\\D', '', 'g')) >= 5 THEN left(regexp_replace(raw, '\\D', '', 'g'), 5) END AS digits FROM t""",
)
def normalize_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    raw = F.when(c % 4 == 0, c.cast("string")).when(c % 4 == 1, F.concat((c + 70000).cast("string"), F.lit("-1234"))).when(c % 4 == 2, F.concat(c.cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), (c + 77000).cast("string")))
    rows = demo.table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select("c_custkey", "raw", *[normalize.ZIP_FORMS[n]("raw").alias(n) for n in ("first_digits", "padded", "digits")])


@query("calendar_features", f"SELECT event_id, year(time)::INT AS year, {CAL} FROM (SELECT event_id, ts AS time FROM events)")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select("event_id", "ts")
    return shown(features.with_calendar(rows, "ts", year=True).drop("ts"))


@query("direction_features", f"WITH {FEEDS_SQL} SELECT wx_id, {SIN_COS} FROM wx")
def direction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.weather(spark, sf_dir).select("wx_id", "wind_direction_10m", "wind_direction_100m")
    return shown(features.with_directions(rows))


@query("wind_vectors", f"WITH {FEEDS_SQL} SELECT wx_id, round(0.3 * wind_speed_10m * cos(radians(wind_direction_10m)) + 0.7 * wind_speed_100m * cos(radians(wind_direction_100m)), 6) + 0.0 AS wind_x, round(0.3 * wind_speed_10m * sin(radians(wind_direction_10m)) + 0.7 * wind_speed_100m * sin(radians(wind_direction_100m)), 6) + 0.0 AS wind_y FROM wx")
def wind_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_directions(demo.weather(spark, sf_dir))
    x, y = features.wind_vector(rows, "blend", 0.7)
    return shown(rows.select("wx_id", x.alias("wind_x"), y.alias("wind_y")))


MINE = ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("distinct_counts", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', (SELECT count(DISTINCT {c}) FROM lineitem))" for c in MINE) + ") t(\"column\", n)")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = stats.distinct_counts(demo.table(spark, sf_dir, "lineitem"), MINE)
    return spark.createDataFrame(list(got.items()), "column string, n long")


@query("prune_low_cardinality", "SELECT l_orderkey, l_quantity, l_discount, l_linestatus FROM lineitem")
def prune_low_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of fewer than eight values go, but for the excluded one."""
    rows = demo.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    return stats.prune_low_cardinality(rows, 8, ["l_linestatus"])[0]


@query("variance_statistics", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', (SELECT round(var_pop({c}) / (max({c}) - min({c})) ** 2, 6) FROM lineitem), (SELECT round(var_pop({c}), 6) FROM lineitem))" for c in MINE[:4]) + ") t(\"column\", normalized, population)")
def variance_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "lineitem")
    one, two = stats.variances(rows, MINE[:4]), stats.variances(rows, MINE[:4], False)
    return shown(spark.createDataFrame([(c, one[c], two[c]) for c in MINE[:4]], "column string, normalized double, population double"))


@query("variance_with_nan", "SELECT round(var_pop(l_tax) / (max(l_tax) - min(l_tax)) ** 2, 6) AS skipped, NULL::DOUBLE AS propagated, round(var_pop(l_tax), 6) AS population, true AS kept FROM lineitem WHERE l_orderkey % 4 <> 0")
def variance_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN left out, or making the statistic NaN, which keeps its column whatever the threshold."""
    rows = demo.table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_orderkey") % 4 == 0, "nan").otherwise(F.col("l_tax").cast("string")).alias("tax"))
    skipped, propagated = (stats.variances(rows, ["tax"], True, policy)["tax"] for policy in ("skip", "propagate"))
    kept = "tax" in stats.prune_low_variance(rows, 100.0, ["tax"], nan_policy="propagate")[0].columns
    return shown(spark.createDataFrame([(skipped, propagated, stats.variances(rows, ["tax"], False)["tax"], kept)], "skipped double, propagated double, population double, kept boolean"))


@query("prune_low_variance", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def prune_low_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return stats.prune_low_variance(rows, 0.01, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], normalized=False)[0]


@query("min_max_scaling", "SELECT l_orderkey, l_linenumber, round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity, 0.0::DOUBLE AS fixed FROM lineitem")
def min_max_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.lit(3.5).alias("fixed"))
    return shown(stats.min_max_scale(rows, ["l_quantity", "fixed"]))


@query("null_profile", "SELECT * FROM (VALUES ('amount', (SELECT count(*) FROM supplier WHERE s_acctbal <= 0)), ('name', (SELECT count(*) FROM supplier WHERE s_suppkey % 7 = 0 OR s_suppkey % 5 = 0)), ('s_suppkey', 0)) t(\"column\", nulls)")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = demo.table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 7 == 0, "nan").when(k % 5 == 0, "").otherwise(F.col("s_name")).alias("name"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("amount"))
    return stats.null_profile(rows)


@query("empty_profile", "SELECT 'name' AS \"column\", count(*) AS nulls FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 = 0")
def empty_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = demo.table(spark, sf_dir, "supplier").select(F.when(k % 7 == 0, "nan").when(k % 5 == 0, "").otherwise(F.col("s_name")).alias("name"))
    return stats.null_profile(rows, empty_only=True)


@query("drop_empty_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit("  ").alias("blank"), F.lit(None).cast("string").alias("nothing"))
    return project.drop_empty_columns(rows)


@query("first_per_key", "SELECT zip, event_id, event_type FROM (SELECT user_id AS zip, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), "event_id", "event_type", "ts")
    return stats.first_per_key(rows, ["zip"], ["ts", "event_id"]).drop("ts")


@query("split_invariant", "SELECT zip, us_aqi, kind FROM (SELECT user_id AS zip, value AS us_aqi, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def split_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), "ts", "event_id", F.col("value").alias("us_aqi"), F.col("event_type").alias("kind"))
    return project.split_invariant(rows, "zip", ["ts", "event_id"], ["us_aqi", "kind"], "ts")[1]


@query("varying_columns", "SELECT 'o_orderstatus' AS \"column\", count(*)::INT AS keys FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1)")
def varying_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "orders").withColumn("same", F.col("o_custkey") % 3)
    got = project.varying_within(rows, "o_custkey", ["o_orderstatus", "same"])
    return spark.createDataFrame(list(got.items()), "column string, keys int")


@query("severity_scale", PAIRS.format(zero="dist_m > 0") + " SELECT round(amount_scale, 6) AS amount_scale, count_scale::DOUBLE AS count_scale FROM sc")
def severity_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = joins.distance_join(demo.places(spark, sf_dir), _facilities(spark, sf_dir), 6000.0, open_at_zero=True)
    return shown(stats.scale_of(written(pairs, "pairs")))


GRID = """g AS (SELECT user_id AS zip, date_trunc('hour', ts) AS time FROM events),
full_grid AS (SELECT zip, t AS time FROM (SELECT DISTINCT zip FROM g), (SELECT unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS t FROM g)),
missing AS (SELECT zip, time FROM full_grid EXCEPT SELECT zip, time FROM g)"""
#: the most frequent difference of neighbouring times, the least among ties
STEP = "SELECT step_s FROM (SELECT (epoch(time) - epoch(lag(time) OVER (ORDER BY time)))::BIGINT AS step_s FROM (SELECT DISTINCT time FROM g)) WHERE step_s IS NOT NULL GROUP BY step_s ORDER BY count(*) DESC, step_s LIMIT 1"


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), F.date_trunc("hour", "ts").alias("time"))


@query("missing_pairs", f"WITH {GRID} SELECT zip, strftime(time, '%Y-%m-%d %H:%M:%S') AS missing_time FROM missing")
def missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(quality.missing_pairs(_hours(spark, sf_dir), "zip", "time"))


@query("missing_by_zip", f"WITH {GRID} SELECT zip, count(*) AS missing_timestep_count FROM missing GROUP BY zip")
def missing_by_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_by(quality.missing_pairs(_hours(spark, sf_dir), "zip", "time"), "zip", "missing_timestep_count")


@query("missing_by_time_top", f"WITH {GRID} SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS missing_time, count(*) AS missing_zip_count FROM missing GROUP BY time ORDER BY 2 DESC, 1 LIMIT 20")
def missing_by_time_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's twenty worst times."""
    return shown(quality.missing_by(quality.missing_pairs(_hours(spark, sf_dir), "zip", "time"), "missing_time", "missing_zip_count").limit(20))


@query("grid_audit", f"WITH {GRID} SELECT (SELECT count(DISTINCT zip) FROM g) AS keys, (SELECT count(DISTINCT time) FROM g) AS times, (SELECT step_s FROM ({STEP})) AS step_s, (SELECT count(*) FROM full_grid) AS expected_pairs, (SELECT count(*) FROM missing) AS missing_pairs")
def grid_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit(_hours(spark, sf_dir), "zip", "time")


@query("unexpected_pairs", "SELECT user_id AS zip, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM (SELECT DISTINCT user_id, date_trunc('minute', ts) AS ts FROM events) WHERE (epoch(ts) - (SELECT epoch(min(date_trunc('minute', ts))) FROM events)) % 7200 <> 0")
def unexpected_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), F.date_trunc("minute", "ts").alias("time"))
    return shown(quality.unexpected_pairs(rows, "zip", "time", 7200))


@query("repeated_pairs", "SELECT count(*) AS rows, count(DISTINCT (user_id, date_trunc('hour', ts))) AS distinct_pairs, count(*) - count(DISTINCT (user_id, date_trunc('hour', ts))) AS repeated_rows FROM events")
def repeated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_pairs(_hours(spark, sf_dir), ["zip", "time"])


@query("modal_step", f"WITH g AS (SELECT date_trunc('hour', ts) AS time FROM events) SELECT 'hours' AS grid, step_s FROM ({STEP}) UNION ALL SELECT * FROM (WITH g AS (SELECT date_trunc('minute', ts) + INTERVAL 7 SECOND * (event_id % 2) AS time FROM events) SELECT 'shifted minutes', step_s FROM ({STEP}))")
def modal_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usual step of a regular and of a rough grid."""
    rough = demo.table(spark, sf_dir, "events").select(F.expr("timestampadd(SECOND, 7 * (event_id % 2), date_trunc('minute', ts))").alias("time"))
    parts = [stats.modal_step(df, "time").select(F.lit(name).alias("grid"), "step_s") for name, df in (("hours", _hours(spark, sf_dir)), ("shifted minutes", rough))]
    return parts[0].unionByName(parts[1])


@query(
    "positional_lags",
    "SELECT event_id, " + ", ".join(f"coalesce(lag(value, {k}) OVER w, -1) AS value_past_{k}" for k in range(1, 9)) + " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
)
def positional_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return lags.add_lags(rows, "user_id", ["ts", "event_id"], ["value"], 8, -1.0).drop("user_id", "ts", "value")


HOURLY = "h AS (SELECT user_id, date_trunc('hour', ts) AS time, max(value) AS value FROM events GROUP BY ALL)"


@query("time_lags", f"WITH {HOURLY} SELECT h.user_id, strftime(h.time, '%Y-%m-%d %H:%M:%S') AS time, h.value, a.value AS value_past_1, b.value AS value_past_2 FROM h LEFT JOIN h a ON a.user_id = h.user_id AND a.time = h.time - INTERVAL 1 HOUR LEFT JOIN h b ON b.user_id = h.user_id AND b.time = h.time - INTERVAL 2 HOUR")
def time_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("hour", "ts").alias("time")).agg(F.max("value").alias("value"))
    return shown(lags.add_time_lags(rows, "user_id", "time", ["value"], 2))


@query("row_ids", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_id FROM events")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags.row_ids(demo.table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


@query("external_sort_order", "SELECT zip, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, event_id, row_number() OVER (ORDER BY zip, g.time, event_id) - 1 AS position FROM (SELECT user_id AS zip, date_trunc('hour', ts) AS time, event_id FROM events) g")
def external_sort_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("zip"), F.date_trunc("hour", "ts").alias("time"), "event_id")
    return shown(lags.row_ids(rows, ["zip", "time", "event_id"], "position"))


@query("hilbert_positions", None)
def hilbert_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in Hilbert order of their grid cells."""
    p = demo.places(spark, sf_dir)
    r = stats.ranges(p, ["x", "y"])
    cell = lambda c: features.grid_cell(c, F.col(f"min_{c}"), F.col(f"max_{c}"), 1 << 8).alias(f"grid_{c}")
    cells = p.join(F.broadcast(r)).select("place", cell("x"), cell("y"))
    rows = cells.withColumn("hilbert_index", features.hilbert_index("grid_x", "grid_y", 8))
    return lags.dense_position(rows, ["hilbert_index", "place"], "hilbert_position")


ORACLES["hilbert_positions"] = f"""WITH RECURSIVE {PLACES_SQL},
c AS (SELECT place, round_even((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) * 255, 0)::BIGINT AS gx, round_even((y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ()) * 255, 0)::BIGINT AS gy FROM places),
h AS (SELECT place, gx, gy, gx AS x, gy AS y, 128::BIGINT AS s, 0::BIGINT AS d FROM c
  UNION ALL
  SELECT place, gx, gy,
    CASE WHEN (y & s) > 0 THEN x WHEN (x & s) > 0 THEN 255 - y ELSE y END,
    CASE WHEN (y & s) > 0 THEN y WHEN (x & s) > 0 THEN 255 - x ELSE x END,
    s // 2, d + s * s * xor(3 * ((x & s) > 0)::BIGINT, ((y & s) > 0)::BIGINT)
  FROM h WHERE s > 0)
SELECT place, gx::INT AS grid_x, gy::INT AS grid_y, d AS hilbert_index, (row_number() OVER (ORDER BY d, place) - 1)::INT AS hilbert_position FROM h WHERE s = 0"""


@query("mercator_points", "SELECT c_custkey, round(6378137.0 * radians(c_custkey % 360 - 180), 3) + 0.0 AS x, round(6378137.0 * ln(tan(pi() / 4 + radians(c_custkey % 160 - 80) / 2)), 3) + 0.0 AS y FROM customer")
def mercator_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = spatial.mercator(F.col("c_custkey") % 360 - 180, F.col("c_custkey") % 160 - 80)
    return shown(demo.table(spark, sf_dir, "customer").select("c_custkey", x.alias("x"), y.alias("y")), 3)


@query("polygon_centroids", "SELECT p_partkey, round((w * h * (p_partkey + w / 2.0) - 1.0 * (p_partkey + 1.5)) / (w * h - 1.0), 6) AS x, round((w * h * (h / 2.0) - 1.0 * 1.5) / (w * h - 1.0), 6) AS y FROM (SELECT p_partkey, p_partkey % 7 + 3 AS w, p_partkey % 5 + 4 AS h FROM part)")
def polygon_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles with a square hole."""
    k, w, h = F.col("p_partkey"), F.col("p_partkey") % 7 + 3, F.col("p_partkey") % 5 + 4
    ring = lambda *xy: F.array(*[spatial.point(a, b) for a, b in xy])
    outer = ring((k, F.lit(0)), (k + w, F.lit(0)), (k + w, h), (k, h), (k, F.lit(0)))
    hole = ring((k + 1, F.lit(1)), (k + 1, F.lit(2)), (k + 2, F.lit(2)), (k + 2, F.lit(1)), (k + 1, F.lit(1)))
    c = spatial.centroid(F.array(outer, hole))
    return shown(demo.table(spark, sf_dir, "part").select("p_partkey", c["x"].alias("x"), c["y"].alias("y")))


CELLS = """c AS (SELECT user_id, date_trunc('hour', ts) AS time, event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
t AS (SELECT time, (row_number() OVER (ORDER BY time) - 1)::INT AS t_idx FROM (SELECT DISTINCT time FROM c)),
p AS (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1)::INT AS h_idx FROM (SELECT DISTINCT user_id FROM c)),
cell AS (SELECT t_idx, h_idx, arg_max(value, event_id) AS v, arg_max(k, event_id) AS k FROM c JOIN t USING (time) JOIN p USING (user_id) GROUP BY ALL),
long AS (SELECT t_idx, 0 AS f_idx, h_idx, v::FLOAT AS value FROM cell UNION ALL SELECT t_idx, 1, h_idx, k::FLOAT FROM cell)"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").select("user_id", F.date_trunc("hour", "ts").alias("time"), "event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return tensor.cells(rows, "time", "user_id", ["value", "k"], ["event_id"])


@query("tensor_cells", f"WITH {CELLS} SELECT t_idx, f_idx, h_idx, round(value::DOUBLE, 4) AS value FROM long")
def tensor_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_cells(spark, sf_dir), 4)


@query("tensor_splits", f"WITH {CELLS}, n AS (SELECT floor(count(*) * 0.7::DOUBLE)::INT AS a, floor(count(*) * 0.2::DOUBLE)::INT AS b FROM t) SELECT CASE WHEN t_idx < a THEN 'train' WHEN t_idx < a + b THEN 'val' ELSE 'test' END AS split, CASE WHEN t_idx < a THEN t_idx WHEN t_idx < a + b THEN t_idx - a ELSE t_idx - a - b END AS t_idx, f_idx, h_idx, round(value::DOUBLE, 4) AS value FROM long, n")
def tensor_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _hours(spark, sf_dir).select("time").distinct().count()
    return shown(tensor.split(_cells(spark, sf_dir), n, 0.7, 0.2, 0.1), 4)


@query("tensor_slices", f"WITH {CELLS} SELECT t_idx, f_idx, count(*) AS observed, round(sum(value::DOUBLE), 2) AS total, (SELECT count(*) FROM p)::INT AS width FROM long GROUP BY t_idx, f_idx")
def tensor_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense slices, summed up."""
    n = demo.table(spark, sf_dir, "events").select("user_id").distinct().count()
    s = tensor.dense_slices(_cells(spark, sf_dir), n)
    seen = F.filter("values", lambda v: v.isNotNull())
    return s.select("t_idx", "f_idx", F.size(seen).cast("long").alias("observed"), F.round(F.aggregate(seen, F.lit(0.0), lambda a, v: a + v.cast("double")), 2).alias("total"), F.size("values").alias("width"))


def _filled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    times, people = _hours(spark, sf_dir).select("time").distinct().count(), demo.table(spark, sf_dir, "events").select("user_id").distinct().count()
    sizes = dict(zip(("train", "val", "test"), tensor.split_sizes(times, 0.7, 0.2, 0.1), strict=True))
    return tensor.filled(tensor.split(_cells(spark, sf_dir), times, 0.7, 0.2, 0.1), 2, sizes, people), people


@query("tensor_filled")
def tensor_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps filled plane by plane, by up to 50 sweeps as in the reference; sequential sweeps have no SQL form."""
    return _filled(spark, sf_dir)[0]


@query("sequence_inputs")
def sequence_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One input vector a time step from the filled tensor."""
    values, people = _filled(spark, sf_dir)
    return tensor.sequence_rows(values, 2, people)


@query("union_of_feeds", f"WITH {FEEDS_SQL} SELECT zip, {TIME}, latitude FROM aq UNION ALL SELECT zip, {TIME}, latitude FROM wx")
def union_of_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import concat_tables

    parts = [f.select(*KEYS, "latitude") for f in (demo.air(spark, sf_dir), demo.weather(spark, sf_dir))]
    return shown(concat_tables(parts))


@query("key_sets", f"WITH {FEEDS_SQL}, u AS (SELECT zip FROM aq UNION SELECT zip FROM wx), i AS (SELECT zip FROM aq INTERSECT SELECT zip FROM wx), d AS (SELECT zip FROM aq EXCEPT SELECT zip FROM wx) SELECT 'either' AS kind, zip FROM u UNION ALL SELECT 'both', zip FROM i UNION ALL SELECT 'left_only', zip FROM d")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = demo.air(spark, sf_dir).select("zip"), demo.weather(spark, sf_dir).select("zip")
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), "zip")
    return named(a.union(b).distinct(), "either").union(named(a.intersect(b), "both")).union(named(a.subtract(b), "left_only"))
