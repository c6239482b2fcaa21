import pytest

from vantle.operators import joins as j


def left(spark):
    return spark.createDataFrame([("a", 1, 10, "l1"), ("a", 1, 11, "l2"), ("b", 1, 12, "l3"), (None, 1, 13, "l4")], "zip string, time int, id int, lat string")


def right(spark):
    return spark.createDataFrame([("a", 1, 20, "r1"), ("c", 1, 21, "r2"), (None, 1, 22, "r3")], "zip string, time int, no int, lat string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_pairing_right_wins(spark):
    out = j.pairing_join(left(spark), right(spark), ["zip", "time"], ["id"], ["no"], marker="side")
    assert out.columns == ["zip", "time", "id", "lat", "no", "side"]
    assert rows(out) == sorted([("a", 1, 10, "r1", 20, "both"), ("a", 1, 11, None, None, "left_only"), ("b", 1, 12, None, None, "left_only"), ("c", 1, None, "r2", 21, "right_only"), (None, 1, 13, "r3", 22, "both")], key=str)
    assert tuple(j.match_counts(out, "side").first()) == (2, 2, 1, 5)


def test_pairing_policies(spark):
    keep = j.pairing_join(left(spark), right(spark), ["zip", "time"], ["id"], ["no"], overlap="coalesce")
    assert ("a", 1, 11, "l2", None) in rows(keep)
    with pytest.raises(ValueError):
        j.pairing_join(left(spark), right(spark), ["zip", "time"], ["id"], ["no"], overlap="error")
    with pytest.raises(ValueError):
        j.pairing_join(left(spark), right(spark), ["zip", "time"], ["id"], ["no"], overlap="first")


def test_left_wins_takes_every_match(spark):
    assert rows(j.left_wins_join(left(spark), right(spark), ["zip", "time"])) == [("a", 1, 10, "l1", 20), ("a", 1, 11, "l2", 20)]


def test_timesteps_compare_as_numbers(spark):
    a = spark.createDataFrame([("z", f"t{i:02}", i) for i in range(1, 13) if i != 9], "zip string, time string, a int")
    b = spark.createDataFrame([("z", f"t{i:02}", i) for i in range(1, 13)], "zip string, time string, b int")
    out = j.timestep_join(a, b, ["zip", "time"], "time", ["a"], ["b"])
    assert sum(r["a"] is not None and r["a"] == r["b"] for r in out.collect()) == 11 and out.count() == 12


def test_lookup_and_missing(spark):
    keys = spark.createDataFrame([("a", 1.0), ("b", None)], "zip string, v double")
    got = {r["id"]: r["v"] for r in j.lookup_join(left(spark), keys, "zip", {"v": 0.0}).collect()}
    assert got == {10: 1.0, 11: 1.0, 12: None, 13: 0.0}
    assert rows(j.missing_keys(right(spark), keys, "zip")) == [("c",), (None,)]


def test_distance_join_is_exact(spark):
    a = spark.createDataFrame([(i, float(i * 7 % 50), float(i * 13 % 50)) for i in range(60)], "i int, x double, y double")
    b = spark.createDataFrame([(i, float(i * 11 % 50) - 25, float(i * 17 % 50)) for i in range(60)], "k int, sx double, sy double")
    want = {(r[0], s[0]) for r in a.collect() for s in b.collect() if (r[1] - s[1]) ** 2 + (r[2] - s[2]) ** 2 <= 64}
    got = [(r["i"], r["k"]) for r in j.distance_join(a, b, 8.0).collect()]
    assert set(got) == want and len(got) == len(want)
