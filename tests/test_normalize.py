import pytest
from pyspark.sql import functions as F

from vantle.functions import normalize as n


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f("v").cast("string").alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("raw", "standard", "stripped"),
    [
        ("2026-03-05T12:34:56-06:00", "2026-03-05 12:34:56", "2026-03-05T12:34:56-06:00"),
        ("2026-03-05 12:34:56Z", "2026-03-05 12:34:56", "2026-03-05 12:34:56"),
        ("2026-03-05 12:34", "2026-03-05 12:34:00", "2026-03-05 12:34"),
        ("bad", None, "bad"),
        ("", None, ""),
        (None, None, None),
    ],
)
def test_times(spark, raw, standard, stripped):
    assert one(spark, raw, n.standard_time) == standard
    assert one(spark, raw, n.strip_after_seconds) == stripped


@pytest.mark.parametrize(
    ("raw", "first", "padded", "digits"),
    [
        ("77002", "77002", "77002", "77002"),
        ("77002.0", "77002", "77002", "77002"),
        ("77002-1234", "77002", "77002-1234", "77002"),
        ("7702", None, "07702", None),
        ("", None, "00000", None),
        (None, None, None, None),
    ],
)
def test_zips(spark, raw, first, padded, digits):
    assert one(spark, raw, n.zip_first_digits) == first
    assert one(spark, raw, n.zip_padded) == padded
    assert one(spark, raw, n.zip_digits) == digits


def test_missing_marks(spark):
    row = spark.createDataFrame([("nan", "", "1.5", "x")], "a string, b string, c string, d string").select(*[n.number(c).alias(c) for c in "abcd"]).first()
    assert row["a"] != row["a"] and row["b"] is None and row["c"] == 1.5 and row["d"] is None


def test_column_detection():
    assert n.find_column(["platform", "LAT"], ["lat"]) == "LAT"
    assert n.find_column(["platform", "x"], ["lat"]) == "platform"
    assert n.find_column(["x"], ["lat"]) is None
    with pytest.raises(ValueError):
        n.require_column(["x"], ["lat"], "latitude")
    assert n.direction_columns(["wind_direction_10m", "a", "Wind_Dir"], ["a", "zz", "Wind_Dir"]) == ["wind_direction_10m", "Wind_Dir", "a"]
    assert n.pick_columns(["TRIFD", "Latitude", "Longitude"], n.FACILITY_HEADERS)["amount"] is None
    with pytest.raises(ValueError):
        n.pick_columns(["a"], n.CHEMICAL_HEADERS)
    assert n.name_list(" a, b,,c ") == ["a", "b", "c"]
    assert n.by_trimmed_name([" time "], "time") == " time "
    assert n.union_names(["a", "b"], ["b", "c"]) == ["a", "b", "c"]


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "i int, s string, b boolean, d double")
    assert n.numeric_columns(df, ["d"]) == ["i", "b"]


def test_clip(spark):
    rows = spark.createDataFrame([(-1.0,), (0.5,), (3.0,), (None,)], "v double").select(n.clip01(F.col("v")).alias("r")).collect()
    assert [r["r"] for r in rows] == [0.0, 0.5, 1.0, None]
