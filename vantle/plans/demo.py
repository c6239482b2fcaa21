"""The test tables in the roles of the engine's inputs.

events stand for the two hourly feeds, suppliers for facilities, line items for
chemicals, nations for places and customers for place texts; coordinates and winds
are fixed arithmetic of keys, so SQL can repeat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: The same feeds in DuckDB SQL, to be put before an oracle's own parts.
FEEDS_SQL = """
ev AS (SELECT event_id, CAST(user_id AS VARCHAR) AS zip, date_trunc('hour', ts) AS time, value,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events),
aq AS (SELECT zip, time, event_id AS aq_id, value AS us_aqi, k AS pm2_5, value AS latitude
       FROM ev WHERE event_type IN ('click', 'view')),
wx AS (SELECT zip, time, event_id AS wx_id, k / 10.0 AS wind_speed_10m, value / 20.0 AS wind_speed_100m,
              (value * 7) % 360 AS wind_direction_10m, (value * 11) % 360 AS wind_direction_100m, k AS latitude
       FROM ev WHERE event_type IN ('purchase', 'signup'))"""

PLACES_SQL = """
places AS (SELECT n_nationkey::VARCHAR AS place, (n_nationkey * 37 % 25) * 1000.0 AS x, (n_nationkey * 11 % 25) * 1000.0 AS y FROM nation),
facilities AS (SELECT s_suppkey AS facility_id, (s_suppkey * 7919 % 24000)::DOUBLE AS sx, (s_suppkey * 104729 % 24000)::DOUBLE AS sy,
                      CASE WHEN s_acctbal > 0 THEN s_acctbal END AS amount FROM supplier),
chemicals AS (SELECT l_suppkey AS facility_id, l_partkey AS chemical, l_extendedprice AS amount FROM lineitem)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds))
    return e.select("event_id", F.col("user_id").cast("string").alias("zip"), F.date_trunc("hour", "ts").alias("time"), "value", F.get_json_object("props", "$.k").cast("double").alias("k"))


def air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ("click", "view")).select("zip", "time", F.col("event_id").alias("aq_id"), F.col("value").alias("us_aqi"), F.col("k").alias("pm2_5"), F.col("value").alias("latitude"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, ("purchase", "signup"))
    return e.select("zip", "time", F.col("event_id").alias("wx_id"), (F.col("k") / 10.0).alias("wind_speed_10m"), (F.col("value") / 20.0).alias("wind_speed_100m"), (F.col("value") * 7 % 360).alias("wind_direction_10m"), (F.col("value") * 11 % 360).alias("wind_direction_100m"), F.col("k").alias("latitude"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(n.cast("string").alias("place"), (n * 37 % 25 * F.lit(1000.0)).alias("x"), (n * 11 % 25 * F.lit(1000.0)).alias("y"))


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """facility_id, amount, sx, sy, and lat and lon as two more numbers."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(s.alias("facility_id"), (s * 104729 % 24000).cast("double").alias("sy"), (s * 7919 % 24000).cast("double").alias("sx"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("amount")).withColumns({"lat": F.col("sy"), "lon": F.col("sx")})


def chemicals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("facility_id"), F.col("l_partkey").alias("chemical"), F.col("l_extendedprice").alias("amount"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(road_id, part): one line of three points a region."""
    r = F.col("r_regionkey")
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    line = F.array(at(r * 5000, F.lit(0)), at(r * 5000 + 700, F.lit(9000)), at(r * 4000, F.lit(24000)))
    return table(spark, sf_dir, "region").select(r.alias("road_id"), line.alias("part"))
