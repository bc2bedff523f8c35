import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeframe.functions import decode_f32, default_output, f32_problem, pipeline_output
from gaugeframe.sources import (generate_telemetry, pick_column, read_bench, read_npy, read_runs, read_telemetry,
                                telemetry_from_ids, write_table)

HEADER = "sensor_id,region,ts,value,value_norm,quality\n"


def test_csv_types_and_bad_cells(spark, tmp_path):
    (tmp_path / "t.csv").write_text(HEADER + "S1,eu-west,1,1.5,,80\nS2,eu-west,2,x,0.5,\n")
    rows = read_telemetry(spark, str(tmp_path / "t.csv"), "csv").orderBy("ts").collect()
    assert [tuple(r) for r in rows] == [("S1", "eu-west", 1, 1.5, None, 80), ("S2", "eu-west", 2, None, 0.5, None)]


def test_csv_with_swapped_header_is_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("region,sensor_id,ts,value,value_norm,quality\neu-west,S1,1,1,1,80\n")
    with pytest.raises(Exception):
        read_telemetry(spark, str(tmp_path / "t.csv"), "csv").collect()


def test_file_uri_parquet_and_csv_round_trip(spark, tmp_path):
    df = generate_telemetry(spark, 500, base_ts=0)
    for fmt in ("parquet", "csv"):
        uri = f"file://{tmp_path}/{fmt}"
        write_table(df, uri, fmt)
        back = read_telemetry(spark, uri, fmt)
        assert back.exceptAll(df).count() == 0 and back.count() == 500
    with pytest.raises(ValueError):
        read_telemetry(spark, "x", "npy")


def test_pick_column(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0)], "s string, n int, value double")
    assert (pick_column(df), pick_column(df, "value"), pick_column(df, default="first"),
            pick_column(df, default="value")) == ("n", "value", "s", "value")
    for bad in (lambda: pick_column(df, "x"), lambda: pick_column(df.select("s"))):
        with pytest.raises(ValueError):
            bad()
    (tmp_path / "x.csv").write_text("name,score\na,1.5\n")
    assert pick_column(read_telemetry(spark, str(tmp_path / "x.csv"), "csv", schema=None)) == "score"


@pytest.mark.parametrize("chunk,whole", [(64, 0), (1000, 0), (1 << 20, 0), (64, 1000), (64, 1 << 20)])
def test_npy_in_ranges(spark, tmp_path, chunk, whole):
    rng = np.random.default_rng(3)
    arrays = {"a": rng.normal(size=777).astype(np.float32), "b": rng.normal(size=(13, 5)),
              "c": np.asfortranarray(rng.integers(0, 99, (7, 4))), "d": np.zeros(0, np.float32),
              "e": rng.normal(size=100).astype(">f8")}
    for name, arr in arrays.items():
        np.save(tmp_path / f"{name}.npy", arr)
    rows = read_npy(spark, str(tmp_path), chunk_bytes=chunk, whole_bytes=whole).collect()
    for name, arr in arrays.items():
        got = sorted((r["idx"], r["value"]) for r in rows if r["path"].endswith(f"/{name}.npy"))
        want = arr.astype(np.float32).ravel()
        assert [i for i, _ in got] == list(range(want.size))
        assert np.array_equal(np.array([v for _, v in got], np.float32), want)


def test_npy_from_a_store_that_only_spark_reads(spark, tmp_path):
    """A mounted file system of Hadoop's, which no other reader knows."""
    np.save(tmp_path / "a.npy", np.arange(12, dtype=np.float64).reshape(3, 4))
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.npytest.link./data", f"file://{tmp_path}")
    rows = read_npy(spark, "viewfs://npytest/data").collect()
    assert sorted((r["idx"], r["value"]) for r in rows) == [(i, float(i)) for i in range(12)]


def test_decode_f32(spark):
    good = base64.b64encode(np.array([1.5, -2.0, 3e-7], "<f4").tobytes()).decode()
    df = spark.createDataFrame([(0, good), (1, None), (2, ""), (3, base64.b64encode(b"abc").decode()), (4, "***")],
                               "id int, payload string")
    got = [r[0] for r in df.orderBy("id").select(decode_f32("payload")).collect()]
    assert got[0] == [1.5, -2.0, pytest.approx(3e-7)] and got[1:] == [None, [], None, None]
    assert [r[0] for r in df.orderBy("id").select(f32_problem("payload")).collect()] == [None, None, None, "length", "base64"]


def test_bench_and_metrics_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text(
        "n,impl,threads,ms_mediana,ms_min,gbps,h2d_ms,kernel_ms,d2h_ms,speedup_vs_1t,err_rel_max\n"
        "1000000,cpu_omp,1,1.531,1.427,7.83801,0,1.531,0,1.0,0\n")
    assert read_bench(spark, str(tmp_path / "b.csv")).first()["ms_mediana"] == 1.531
    (tmp_path / "m.json").write_text(json.dumps(
        {"pipeline": "rdd", "input": "x", "runs": 2, "times_s": [3.0, 1.0], "median_s": 3.0, "min_s": 1.0,
         "groups": 4, "anomalies": 1, "top": [{"region": "eu-west", "readings": 3}], "spark_version": "3.5.1"}, indent=2))
    rows = read_runs(spark, str(tmp_path / "m.json")).collect()
    assert [tuple(r) for r in rows] == [("rdd", "x", 0, 3.0, 4, 1), ("rdd", "x", 1, 1.0, 4, 1)]


def test_generator_shape(spark):
    df = generate_telemetry(spark, 50_000, sensors=100, anomaly_rate=0.004, base_ts=1000, block_rows=20_000)
    row = df.agg(F.count("*"), F.countDistinct("sensor_id"), F.avg("quality"), F.min("ts"), F.max("ts"),
                 F.avg((F.col("region") == "us-east").cast("int")), F.min("quality"), F.max("quality")).first()
    assert row[0] == 50_000 and row[1] == 100 and 77 < row[2] < 81
    assert 1000 <= row[3] and row[4] < 1000 + 86400 * 30
    assert abs(row[5] - 0.30) < 0.01 and row[6] >= 0 and row[7] == 100
    plain = generate_telemetry(spark, 50_000, sensors=100, anomaly_rate=0.0, base_ts=1000, block_rows=20_000)
    shifted = df.select("value").exceptAll(plain.select("value")).count()
    assert shifted == 80 + 80 + 40
    stats = plain.agg(F.avg("value"), F.stddev_pop("value")).first()
    assert abs(stats[0] - 100) < 0.5 and abs(stats[1] - 25) < 0.5


def test_generator_does_not_depend_on_partitioning(spark):
    one, many = (generate_telemetry(spark, 3000, base_ts=0, partitions=n) for n in (1, 11))
    assert one.exceptAll(many).count() == 0
    assert one.exceptAll(generate_telemetry(spark, 3000, base_ts=0, seed=7)).count() > 2900
    ids = spark.range(10)
    assert telemetry_from_ids(ids, "id").exceptAll(telemetry_from_ids(ids.repartition(3), "id")).count() == 0


def test_output_paths(spark):
    df = spark.createDataFrame([("s3://b/d/x.parquet", "j"), ("x", "j"), ("s3://b/d/", "j")], "u string, j string")
    assert [r[0] for r in df.select(default_output("u", "j")).collect()] == [
        "s3://b/d/processed/j/", "processed/j/", "s3://b/d/processed/j/"]
    assert df.select(pipeline_output(F.lit("o/"), F.lit("rdd")), pipeline_output(F.lit(None), F.lit("rdd"))).first()[:] == ("o/rdd", "")
