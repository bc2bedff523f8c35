import math

import pytest
from pyspark.sql import functions as F

from gaugeframe.functions import normalize_array
from gaugeframe.operators import column_stats, normalize, normalize_modes, normalize_summary

MODES = {"z": "zscore", "m": "minmax", "r": "robust"}


def values(spark, xs):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, value double")


def column(df, name="value_norm"):
    return [r[name] for r in df.orderBy("id").collect()]


def test_zscore_of_ten_to_hundred(spark):
    out = normalize(values(spark, [float(x) for x in range(10, 101, 10)]), "value")
    row = out.agg(F.avg("value_norm"), F.stddev_pop("value_norm")).first()
    assert abs(row[0]) < 1e-12 and abs(row[1] - 1) < 1e-12


def test_five_values_all_modes(spark):
    out = normalize_modes(values(spark, [10.0, 20.0, 30.0, 40.0, 50.0]), "value", MODES)
    sd = math.sqrt(200)
    assert column(out, "z") == pytest.approx([-20 / sd, -10 / sd, 0, 10 / sd, 20 / sd])
    assert column(out, "m") == pytest.approx([0, 0.25, 0.5, 0.75, 1])
    assert column(out, "r") == pytest.approx([-0.5, -0.25, 0, 0.25, 0.5])


def test_null_and_nan_stay_out_of_the_statistics(spark):
    out = normalize(values(spark, [1.0, None, float("nan"), 3.0]), "value")
    assert column(out) == [-1.0, None, None, 1.0]


def test_constant_column_is_zero(spark):
    for mode in MODES.values():
        assert column(normalize(values(spark, [5.0] * 3), "value", mode)) == [0.0] * 3


def test_no_values(spark):
    assert normalize(values(spark, []), "value").collect() == []
    assert column(normalize(values(spark, [None, None]), "value")) == [None, None]
    stats = column_stats(values(spark, []), "value").first()
    assert stats["n"] == 0 and stats["mean"] is None


def test_unknown_mode(spark):
    for call in (normalize, normalize_summary):
        with pytest.raises(ValueError):
            call(values(spark, [1.0]), "value", "logaritmica")


def test_population_stddev_of_large_values(spark):
    stats = column_stats(values(spark, [1e9, 1e9 + 1, 1e9 + 2]), "value").first()
    assert stats["stddev"] == pytest.approx(0.816496580927726)


def test_partitioning_does_not_change_the_result(spark):
    base = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 101).cast("double").alias("value"))
    one, many = (column(normalize(base.repartition(n), "value")) for n in (1, 13))
    assert one == pytest.approx(many, abs=1e-12)


def test_minmax_stays_within_bounds(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = normalize(lines, "l_extendedprice", "minmax").agg(
        F.min("value_norm"), F.max("value_norm")).first()
    assert row[0] == 0 and row[1] == pytest.approx(1, abs=1e-12)


@pytest.mark.parametrize("hot_keys", [1, 3, 10_000])
def test_by_key_with_one_key_holding_most_rows(spark, hot_keys):
    """Hot, ordinary, single-row and NULL keys, on both sides of the broadcast bound."""
    rows = [(i, "hot" if i % 3 else f"k{i % 17}" if i % 2 else None, float(i * i % 97))
            for i in range(900)] + [(900, "single", 4.0)]
    df = spark.createDataFrame(rows, "id int, k string, value double").repartition(5)
    got = {r["id"]: r["z"] for r in
           normalize_modes(df, "value", {"z": "zscore"}, by=["k"], hot_keys=hot_keys).collect()}
    groups = {}
    for _, k, v in rows:
        groups.setdefault(k, []).append(v)
    assert len(got) == len(rows)
    for i, k, v in rows:
        xs = groups[k]
        mean = sum(xs) / len(xs)
        sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / len(xs))
        assert got[i] == pytest.approx((v - mean) / sd if sd > 1e-12 else 0.0, abs=1e-9)


def test_array_edges(spark):
    df = spark.createDataFrame(
        [(0, [10.0, 20.0, 30.0]), (1, [5.0, 5.0]), (2, []), (3, None), (4, [1.0, None, 3.0]),
         (5, [float("nan"), 1.0, 3.0])], "id int, v array<float>")
    got = column(df.select("id", normalize_array("v", "zscore").alias("value_norm")))
    assert got[0] == pytest.approx([-1.224744871391589, 0, 1.224744871391589])
    assert got[1:] == [[0.0, 0.0], [], None, [-1.0, None, 1.0], [None, -1.0, 1.0]]


def test_float_precision_yields_float(spark):
    out = normalize(values(spark, [1.0, 2.0, 4.0]), "value", precision="float")
    assert dict(out.dtypes)["value_norm"] == "float"
    assert column(out) == pytest.approx(column(normalize(values(spark, [1.0, 2.0, 4.0]), "value")), rel=1e-6)
