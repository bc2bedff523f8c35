import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.order_stats import bracket_values, count_inside
from gaugeframe.operators import (analyze_jobs, bench_pivot, compare_runs, middle_values,
                                  timing_summary)
from gaugeframe.schema import BENCH


def groups():
    rng = random.Random(5)
    return {
        "even": [1.0, 2.0, 4.0, 8.0], "one": [7.5], "two": [3.0, 1.0], "same": [2.0] * 9,
        "normal": [rng.gauss(0, 1) for _ in range(301)],
        "wide": [10.0 ** rng.uniform(-20, 20) * rng.choice([-1, 1]) for _ in range(400)],
        "modes": [rng.choice([0.0, 1e9]) + rng.random() for _ in range(500)],
        "ties": [float(rng.randrange(4)) for _ in range(600)],
        "infinite": [math.inf, -math.inf, 1.0, 2.0, 3.0], "extreme": [-1e308, 1e308, 5.0, 6.0],
        None: [1.0, 5.0, 9.0],
    }


@pytest.mark.parametrize("options", [{}, {"hot_keys": 1}, {"hot_keys": 3, "accuracy": 100}, {"accuracy": 10}])
def test_middle_values_are_exact(spark, options):
    data = groups()
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("even", None), ("one", math.nan)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r["k"]: (r["lower_middle"], r["upper_middle"])
           for r in middle_values(df, ["k"], "v", **options).collect()}
    want = {k: (sorted(vs)[(len(vs) - 1) // 2], sorted(vs)[len(vs) // 2]) for k, vs in data.items()}
    assert got == want


@pytest.mark.parametrize("hot_keys", [1, 1_000])
def test_timing_summary(spark, hot_keys):
    data = {k: [abs(x) + 1 for x in v] for k, v in groups().items() if k not in ("infinite", "extreme", "wide")}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("none", None)],
                               "k string, v double")
    got = {r["k"]: r for r in timing_summary(df, ["k"], "v", hot_keys=hot_keys).collect()}
    for k, vs in data.items():
        sd = statistics.stdev(vs) if len(vs) > 1 else 0.0
        assert tuple(got[k])[1:] == pytest.approx(
            (len(vs), statistics.median(vs), statistics.fmean(vs), sd, min(vs), max(vs),
             sd / statistics.fmean(vs) * 100))
    assert tuple(got["none"])[1:] == (0, None, None, None, None, None, None)


def test_upper_median(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 4.0, 8.0)], "k string, v double")
    assert timing_summary(df, ["k"], "v").first()["median"] == 3.0
    assert timing_summary(df, ["k"], "v", median="upper").first()["median"] == 4.0


def test_compare_runs(spark):
    rows = [("j1", "rdd", 42.0), ("j1", "dataframe", 14.0), ("j2", "rdd", 5.0),
            ("j3", "rdd", 1.0), ("j3", "dataframe", 0.0), ("j4", "other", 1.0)]
    df = spark.createDataFrame(rows, "job_id string, pipeline string, seconds double")
    got = {r["job_id"]: tuple(r)[1:] for r in compare_runs(df, "rdd", "dataframe").collect()}
    assert got["j1"] == (42.0, 14.0, 3.0, pytest.approx(66.6666667))
    assert got["j2"] == (5.0, None, None, None)
    assert got["j3"][:3] == (1.0, 0.0, None)
    assert "j4" not in got


def test_job_analysis(spark):
    norm = spark.createDataFrame([("a", "cuda", 60.0), ("b", "openmp", 90.0), ("c", "cuda", 1.0),
                                  ("d", "cuda", 1.0), ("e", "cuda", 1.0), ("f", "cuda", 1.0)],
                                 "job_id string, backend string, total_s double")
    rows = [("a", "rdd", 1, 5000, 200, 42.0), ("a", "dataframe", 2, 5000, 200, 14.0),
            ("b", "rdd", 1, 100, 6, 60.0), ("b", "dataframe", 2, 101, 4, 50.0),
            ("c", "rdd", 1, 100, 0, 5.0), ("d", "rdd", 1, 10, 0, 1.0), ("d", "dataframe", 2, 10, 0, 4.0),
            ("d", "dataframe", 3, 10, 0, 9.0), ("e", "rdd", 1, 0, 0, 0.0), ("e", "dataframe", 2, 0, 0, 2.0)]
    runs = spark.createDataFrame(
        rows, "job_id string, pipeline string, run_id int, groups long, anomalies long, median_s double")
    got = {r["job_id"]: r for r in analyze_jobs(norm, runs).collect()}
    assert (got["a"]["speedup"], got["a"]["anomaly_rate"], got["a"]["warnings"]) == (3.0, 0.04, [])
    assert got["a"]["verdict"] == "DataFrame es 3.00x más rápido que RDD"
    assert len(got["b"]["warnings"]) == 3 and "CPU" in got["b"]["warnings"][0]
    assert "(5.9%)" in got["b"]["warnings"][2]
    assert got["b"]["verdict"] == "DataFrame es marginalmente más rápido (1.20x)"
    assert got["c"]["verdict"] == "sólo se ejecutó un pipeline: sin comparación disponible"
    assert got["d"]["verdict"].startswith("RDD resultó más rápido (4.00x)")
    assert got["e"]["anomaly_rate"] == 0.0 and "(Infinityx)" in got["e"]["verdict"]
    assert got["f"]["anomaly_rate"] == 0.0 and got["f"]["speedup"] is None


def test_bench_pivot(spark):
    def row(n, impl, threads, ms, h2d=0.0, kernel=0.0, d2h=0.0):
        return (n, impl, threads, ms, ms, 0.0, h2d, kernel, d2h, 1.0, 0.0)

    df = spark.createDataFrame([
        row(1_000_000, "cpu_omp", 1, 1.531), row(1_000_000, "cpu_omp", 8, 0.61),
        row(10, "cpu_omp", 8, 1.0), row(30, "cpu_omp", 1, 0.0), row(30, "gpu_cuda", 4, 0.0), row(20, "cpu_omp", 1, 4.0),
        row(20, "gpu_cuda", 4, 2.0, 0.5, 0.25, 0.5)], BENCH)
    got = {r["n"]: r for r in bench_pivot(df).collect()}
    assert set(got) == {1_000_000, 20, 30}
    assert got[1_000_000]["cpu_speedup"] == pytest.approx(2.50984, rel=1e-4)
    assert got[1_000_000]["cpu1_gbps"] == pytest.approx(7.83801, rel=1e-4)
    assert got[1_000_000]["cpu_efficiency_pct"] == pytest.approx(31.373, rel=1e-3)
    assert got[1_000_000]["gpu_ms"] is None
    assert (got[20]["gpu_speedup_vs_1"], got[20]["transfer_pct"], got[20]["cpun_ms"]) == (2.0, 50.0, None)
    assert (got[30]["gpu_speedup_vs_1"], got[30]["transfer_pct"], got[30]["cpu1_gbps"]) == (None, None, 0.0)


@pytest.mark.parametrize("value", [
    "rand(1)", "CASE id WHEN 7 THEN 1e9D WHEN 8 THEN 1e18D ELSE rand(1) END", "pow(rand(1), -3)",
    "CASE id WHEN 7 THEN double('-inf') WHEN 8 THEN double('inf') ELSE rand(1) END", "1.0D"])
def test_middle_values_narrow_any_range(spark, value):
    rows = spark.range(200_000).selectExpr("1 AS k", f"{value} AS __v")
    bracket = bracket_values(rows, ["k"])
    left = count_inside(rows.join(bracket, "k"), ["k"])
    assert left.count() <= 1_000
    got = middle_values(rows.withColumnRenamed("__v", "v"), ["k"], "v").first()
    v = sorted(r[0] for r in rows.select("__v").collect())
    assert (got["lower_middle"], got["upper_middle"]) == (v[99_999], v[100_000])


def _of_large_keys(df, slices, accuracy=10_000):
    out = middle_values(df, ["k"], "v", accuracy=accuracy, large_keys=True, slices=slices)
    return {r[0]: (r[1], r[2]) for r in out.collect()}


def test_large_keys_are_narrowed_to_the_value(spark):
    """Distributions that even slices alone would not part: many octaves, infinities, ties, signs."""
    rng = random.Random(3)
    groups = {
        "octaves": [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1070, 1020) for _ in range(3001)],
        "inf": [float("inf")] * 900 + [float("-inf")] * 900 + [rng.gauss(0, 1) for _ in range(2000)],
        "ties": [5.0] * 2000 + [rng.random() for _ in range(1999)], "zero": [0.0] * 50 + [-1e-310, 1e-310] * 1200,
        "close": [1.0 + i * 2.0 ** -52 for i in range(2600)], "all inf": [float("inf")] * 2600,
        "small": [1.0, 2.0], "one": [7.0], None: [float(i) for i in range(2700)]}
    rows = [(k, v) for k, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + [("none", None)], "k string, v double").repartition(5)
    want = {}
    for k, values in groups.items():
        s = sorted(values)
        want[k] = (s[(len(s) - 1) // 2], s[len(s) // 2])
    assert _of_large_keys(df, 4096, accuracy=7) == want  # keys of more than 2,389 rows are narrowed
    assert _of_large_keys(df, 65_536) == want


def test_one_key_of_ten_million_rows(spark):
    """The widest window of the plan orders no more rows than there are slices."""
    n, slices = 10_000_000, 1000
    df = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    out = middle_values(df, ["k"], "v", large_keys=True, slices=slices)
    assert [tuple(r) for r in out.collect()] == [(1, 4_999_999.0, 5_000_000.0)]
    widest, plans = 0, [out._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(p.executedPlan())
        elif "QueryStageExec" in name:
            plans.append(p.plan())
        else:
            if name == "WindowExec":
                widest = max(widest, p.child().metrics().apply("numOutputRows").value()
                             if p.child().metrics().contains("numOutputRows") else 0)
                plans_below = p.child()
                while plans_below.children().size() and "AQEShuffleRead" not in plans_below.getClass().getSimpleName():
                    plans_below = plans_below.children().head()
                if plans_below.metrics().contains("numOutputRows"):
                    widest = max(widest, plans_below.metrics().apply("numOutputRows").value())
            children = p.children().iterator()
            while children.hasNext():
                plans.append(children.next())
    assert 0 < widest <= 2 * (slices + 1)  # two wanted ranks
