import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vantle.operators import lags, project, quality, stats

NAN = float("nan")


def test_variance_policies(spark):
    df = spark.createDataFrame([("1", "5", NAN), ("1", "5", NAN), ("nan", "5", NAN)], "a string, b string, c double")
    skip = stats.variances(df, ["a", "b", "c"])
    assert skip["a"] == 0 and skip["b"] == 0 and skip["c"] is None
    spread = stats.variances(df, ["a"], nan_policy="propagate")["a"]
    assert math.isnan(spread)
    assert stats.prune_low_variance(df, 0.1, ["a", "b", "c"], ["b"])[1].removed == ["a"]


def test_distinct_counts_fold_missing(spark):
    df = spark.createDataFrame([(" x ",), ("x",), ("",), (None,), ("nan",), ("NaN",)], "a string")
    assert stats.distinct_counts(df, ["a"]) == {"a": 2}
    kept, report = stats.prune_low_cardinality(df.withColumn("b", df["a"]), 3, ["b"])
    assert kept.columns == ["b"] and report.removed == ["a"]


def test_null_profiles_differ(spark):
    df = spark.createDataFrame([("nan",), ("",), (None,), ("NA",), ("1",)], "a string")
    assert stats.null_profile(df).first()["nulls"] == 4
    assert stats.null_profile(df, empty_only=True).first()["nulls"] == 2


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, None)], "a double, b double")
    assert [tuple(r) for r in stats.min_max_scale(df, ["a", "b"]).collect()] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_scale_falls_back(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 0)], "amount double, chemical_count int")
    assert tuple(stats.scale_of(df).first()) == (1.0, 1.0)
    assert tuple(stats.scale_of(df.limit(0)).first()) == (1.0, 1.0)


def test_lags(spark):
    df = spark.createDataFrame([("a", 1, "1"), ("a", 3, "x"), ("a", 4, "4"), ("b", 1, "7")], "zip string, t int, v string")
    got = {(r["zip"], r["t"]): (r["v_past_1"], r["v_past_2"]) for r in lags.add_lags(df, "zip", ["t"], ["v"], 2).collect()}
    assert got == {("a", 1): (None, None), ("a", 3): (1.0, None), ("a", 4): (None, 1.0), ("b", 1): (None, None)}
    with pytest.raises(ValueError):
        lags.add_lags(df, "zip", ["t"], ["w"], 1)
    assert lags.add_lags(df, "zip", ["t"], ["w"], 1, -1.0, strict=False).first()["w_past_1"] == -1.0


def test_row_ids_are_dense(spark):
    df = spark.range(500).selectExpr("(id * 37) % 500 as v")
    assert [(r["v"], r["n"]) for r in lags.row_ids(df, ["v"], "n").orderBy("n").collect()] == [(i, i) for i in range(500)]
    assert lags.row_ids(df.limit(0), ["v"], "n").count() == 0


def test_audit(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([("a", t(0)), ("a", t(1)), ("a", t(1)), ("a", t(3)), ("b", t(0)), ("b", dt.datetime(2024, 1, 1, 2, 30))], "zip string, time timestamp")
    assert quality.step_of(df, "time") == 1800 or quality.step_of(df, "time") == 3600
    missing = {(r[0], r[1].hour) for r in quality.missing_pairs(df, "zip", "time", 3600).collect()}
    assert missing == {("a", 2), ("b", 1), ("b", 2), ("b", 3)}
    assert quality.unexpected_pairs(df, "zip", "time", 3600).count() == 1
    assert tuple(quality.repeated_pairs(df, ["zip", "time"]).first()) == (6, 5, 1)
    assert quality.missing_pairs(df.limit(0), "zip", "time", 3600).count() == 0


def test_unexpected_pairs_without_a_grid(spark):
    rows = [("a", "2024-03-01 00:00:00"), ("a", "2024-03-10 07:30:01"), ("a", "2024-03-10 07:30:02"), (None, "2024-03-10 07:30:01"), ("b", None)]
    df = spark.createDataFrame(rows, "zip string, t string").selectExpr("zip", "cast(t as timestamp) as time")
    got = quality.unexpected_pairs(df, "zip", "time", 2)
    # keys x 400,000 steps: the grid must not be made
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "sequence" not in plan
    assert {(r[0], r[1].second) for r in got.collect()} == {("a", 1), (None, 1)}
    for kind in ("timestamp_ntz", "date"):
        days = df.select("zip", F.col("time").cast(kind).alias("time"))
        assert quality.unexpected_pairs(days.filter("time is not null"), "zip", "time", 86_400 * 9).count() == {"timestamp_ntz": 3, "date": 0}[kind]


def test_unexpected_pairs_by_days_of_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # noon of both days by the clock, 23 hours apart, and an hour later
        df = spark.sql("select 'a' as zip, explode(array(timestamp'2024-03-09 12:00:00', timestamp'2024-03-10 12:00:00', timestamp'2024-03-10 13:00:00')) as time")
        assert [str(r[0]) for r in quality.unexpected_pairs(df, "zip", "time", 86_400).select(F.col("time").cast("string")).collect()] == ["2024-03-10 13:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_projection(spark):
    df = spark.createDataFrame([("k", 1, " ", None), ("k", 2, "", None)], "zip string, v int, blank string, nothing string")
    assert project.drop_columns(df, ["v", "absent"], ["zip"]).columns == ["zip", "blank", "nothing"]
    with pytest.raises(ValueError):
        project.drop_columns(df, ["zip"], ["zip"])
    with pytest.raises(ValueError):
        project.drop_columns(df, ["absent"], strict=True)
    assert project.drop_empty_columns(df).columns == ["zip", "v"]
    assert project.varying_within(df, "zip", ["v", "blank"]) == {"v": 1, "blank": 1}
    rest, fixed = project.split_invariant(df, "zip", ["v"], ["v"])
    assert rest.columns == ["zip", "blank", "nothing"] and [tuple(r) for r in fixed.collect()] == [("k", 1)]
    assert project.output_columns(["zip", "a", "wd"], ["zip", "a", "b"], ["zip"], ["wd"], True, ["a"], 1)[:5] == ["zip", "a", "b", "wd_sin", "wd_cos"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50)), min_size=1, max_size=20, unique_by=lambda x: x))
def test_lag_of_lag(spark, keys):
    df = spark.createDataFrame([(k, t, float(t)) for k, t in keys], "zip string, t int, v double")
    one = lags.add_lags(df, "zip", ["t"], ["v"], 2)
    two = lags.add_lags(one, "zip", ["t"], ["v_past_1"], 1)
    assert all(r["v_past_1_past_1"] == r["v_past_2"] for r in two.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 20, 1001])
def test_exact_quantile(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 5.0, rng.normal(5, 3, n).round(1))  # one value holds a large part of the rows
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    for share in (0.0, 0.5, 0.95, 1.0):
        assert stats.exact_quantile(df, "v", share) == pytest.approx(np.quantile(values, share))
    assert stats.exact_quantile(df.filter("v is null"), "v", 0.5) is None
