import math

from gaugeframe.operators import anomaly_profile, diff_tables, equivalent, max_rel_error

SCHEMA = "sensor_id string, region string, value_norm double, quality int"


def profile(spark, rows):
    return anomaly_profile(spark.createDataFrame(rows, SCHEMA))


def test_equal_profiles_have_no_problems(spark):
    rows = [(f"s{i}", "r", float(i), 80) for i in range(9)]
    assert equivalent(profile(spark, rows), profile(spark, rows[::-1])).collect() == []
    assert equivalent(profile(spark, []), profile(spark, [])).collect() == []


def test_problems_by_kind(spark):
    base = [("a", "r", 9.0, 80), ("b", "r", 9.0, 80), ("b", "r", 0.0, 80)]
    more = [*base, ("c", "r", 0.0, 80)]
    found = equivalent(profile(spark, base), profile(spark, more)).collect()
    assert [tuple(r) for r in found] == [("groups", None, "2", "3")]
    moved = [("a", "r", 9.0, 80), ("b", "r", 9.0, 80), ("b", "r", 0.0, 80), ("b", "r", 0.0, 80)]
    found = equivalent(profile(spark, base), profile(spark, moved)).collect()
    assert [(r["check"], r["position"]) for r in found] == [("top_ratio", 2)]
    other = [("z", "r", 9.0, 80), ("b", "r", 9.0, 80), ("b", "r", 0.0, 80)]
    found = equivalent(profile(spark, base), profile(spark, other)).collect()
    assert [tuple(r) for r in found] == [("top_sensor", 1, "a", "z")]


def test_diff_kinds(spark):
    schema = "k string, v double"
    a = spark.createDataFrame([("same", 1.0), ("near", 1.0), ("far", 1.0), (None, 2.0), ("left", 1.0),
                               ("dup", 1.0), ("dup", 1.0), ("null", None), ("nan", math.nan),
                               ("inf", math.inf), ("gone", None)], schema)
    b = spark.createDataFrame([("same", 1.0), ("near", 1.0 + 1e-9), ("far", 1.1), (None, 2.5),
                               ("right", 1.0), ("dup", 1.0), ("null", None), ("nan", math.nan),
                               ("inf", math.inf), ("gone", 1.0)], schema)
    got = {(r["k"], r["status"]): (r["left"], r["right"]) for r in diff_tables(a, b, ["k"], ["v"]).collect()}
    assert got == {("far", "value"): (1.0, 1.1), (None, "value"): (2.0, 2.5),
                   ("left", "missing_right"): (None, None), ("right", "missing_left"): (None, None),
                   ("dup", "duplicate"): (None, None), ("gone", "value"): (None, 1.0)}


def test_max_rel_error(spark):
    df = spark.createDataFrame([(2.0, 2.0), (0.0, 1e-7), (-4.0, -5.0)], "ref double, got double")
    assert tuple(max_rel_error(df, "ref", "got").first()) == (0.25, 3, 0)
    df = spark.createDataFrame([(2.0, None), (None, 1.0), (None, None)], "ref double, got double")
    assert tuple(max_rel_error(df, "ref", "got").first()) == (None, 0, 2)


def test_missing_sensor_is_a_problem(spark):
    base, other = [(None, "r", 9.0, 80)], [("x", "r", 9.0, 80)]
    found = equivalent(profile(spark, base), profile(spark, other)).collect()
    assert [tuple(r) for r in found] == [("top_sensor", 1, None, "x")]
