import pytest
from pyspark.sql import functions as F

from gaugeframe.operators import (anomaly_profile, enrich, filter_quality, metrics_record,
                                  profile_totals, top_anomalies)

SCHEMA = "sensor_id string, region string, value_norm double, quality int"


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_key(df):
    return {(r["region"], r["sensor_id"]): r for r in df.collect()}


def test_quality_edge_and_null(spark):
    df = readings(spark, [("a", "r", 1.0, 59), ("b", "r", 1.0, 60), ("c", "r", 1.0, None)])
    assert [r["sensor_id"] for r in filter_quality(df).collect()] == ["b"]


def test_null_policies_and_nan(spark):
    df = readings(spark, [("a", "r", 4.0, 80), ("a", "r", None, 80), ("a", "r", float("nan"), 80),
                          ("n", "r", None, 80)])
    skip = by_key(anomaly_profile(df))
    assert skip["r", "a"][2:] == (3, 4.0, 0.0, 4.0, 4.0, 1, pytest.approx(1 / 3))
    assert skip["r", "n"][2:] == (1, None, None, None, None, 0, 0.0)
    zero = by_key(anomaly_profile(df, null_policy="zero"))
    assert zero["r", "a"]["mean_norm"] == pytest.approx(4 / 3)
    assert zero["r", "n"][2:] == (1, 0.0, 0.0, 0.0, 0.0, 0, 0.0)


def test_threshold_is_strict(spark):
    df = readings(spark, [("a", "r", 3.0, 80), ("a", "r", -3.0, 80), ("a", "r", -3.0001, 80)])
    assert anomaly_profile(df).first()["anomalies"] == 1


def test_unknown_and_null_region(spark):
    df = anomaly_profile(readings(spark, [("a", "eu-west", 0.0, 80), ("a", "mars", 0.0, 80),
                                          ("a", None, 0.0, 80)]))
    dims = {r["region"]: (r["continent"], r["sla_ms"], r["tier"]) for r in enrich(df).collect()}
    assert dims == {"eu-west": ("EU", 250, "gold"), "mars": ("??", 999, "unknown"),
                    None: ("??", 999, "unknown")}
    nulls = {r["region"]: r["tier"] for r in enrich(df, unmatched="null").collect()}
    assert nulls == {"eu-west": "gold", "mars": None, None: None}


def test_own_dimension_keeps_its_nulls(spark):
    dim = spark.createDataFrame([("a", None)], "region string, tier string")
    df = spark.createDataFrame([("a",), ("b",)], "region string")
    got = {r["region"]: r["tier"] for r in enrich(df, dim, defaults={"tier": "none"}).collect()}
    assert got == {"a": None, "b": "none"}


@pytest.mark.parametrize("hot_keys", [1, 2, 100])
def test_large_dimension_is_the_same_join(spark, hot_keys):
    """Hot, missing and NULL keys, repeated keys of the dimension, rows that differ in nothing."""
    df = spark.createDataFrame([("a", 1)] * 40 + [("b", 2), (None, 3), (None, 3), ("z", 4), ("c", 5)], "region string, x int")
    dim = spark.createDataFrame([("a", "A"), ("b", None), ("c", "C1"), ("c", "C2"), ("d", "D")], "region string, tier string")
    for options in ({"defaults": {"tier": "none"}}, {"unmatched": "null"}):
        plain, large = (enrich(df, dim, large=large, hot_keys=hot_keys, **options) for large in (False, True))
        assert plain.columns == large.columns == ["region", "x", "tier"]
        assert sorted(map(str, plain.collect())) == sorted(map(str, large.collect()))


def test_ties_are_broken_by_keys(spark):
    df = anomaly_profile(readings(spark, [(s, r, 5.0, 80) for s in "dcba" for r in "yx"]))
    top = [(r["region"], r["sensor_id"]) for r in top_anomalies(df.repartition(3), 5).collect()]
    assert top == [("x", "a"), ("x", "b"), ("x", "c"), ("x", "d"), ("y", "a")]


def test_empty_input(spark):
    profile = anomaly_profile(readings(spark, []))
    assert tuple(profile_totals(profile).first()) == (0, 0)
    assert top_anomalies(profile).collect() == []


def test_metrics_record(spark):
    profile = enrich(anomaly_profile(readings(spark, [(f"s{i}", "eu-west", float(i), 80)
                                                      for i in range(8)])))
    row = metrics_record(profile, [4.0, 1.0, 2.0, 8.0], "dataframe", "in").first()
    assert (row["median_s"], row["min_s"], row["runs"], row["groups"], row["anomalies"]) == (4.0, 1.0, 4, 8, 4)
    assert [t["sensor_id"] for t in row["top"]] == ["s4", "s5", "s6", "s7", "s0"]
    assert metrics_record(profile.filter(F.lit(False)), [1.0], "p", "in").first()["top"] == []
