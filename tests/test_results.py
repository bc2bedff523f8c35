"""Typed stage results, analyses from a log, whole statuses as JSON, instants."""

import json
import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gaugeframe.functions.instants import parse_instant, print_instant
from gaugeframe.functions.typed_json import bool_field, double_field, elements, long_field, parse_json, string_field, text_field
from gaugeframe.operators import analyze_folded, decode_status, encode_status, typed_jobs
from test_jobs import T0, log


def test_instants(spark):
    cases = [("2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z"), ("2026-01-01T00:00:00.5Z", "2026-01-01T00:00:00.500Z"),
             ("2026-01-01T10:20:30.000123Z", "2026-01-01T10:20:30.000123Z"),
             ("2026-01-01T10:20:30.123456789Z", "2026-01-01T10:20:30.123456Z"),
             ("2026-01-01T00:30:00+02:00", "2025-12-31T22:30:00Z"), ("2026-01-01T00:30:00-00:45", "2026-01-01T01:15:00Z"),
             ("2026-01-01t00:00:00z", "2026-01-01T00:00:00Z"), ("2026-02-30T00:00:00Z", None), ("2026-01-01T25:00:00Z", None),
             ("2026-01-01 00:00:00Z", None), ("2026-01-01T00:00:00", None), ("x", None), ("", None), (None, None),
             ("2026-01-01T00:00:00+19:00", None), ("2026-01-01T00:00:00.1234567890Z", None)]
    df = spark.createDataFrame([(a, b) for a, b in cases], "t string, want string")
    got = df.select("t", print_instant(parse_instant("t")).alias("got"), "want").collect()
    assert [(r.t, r.got) for r in got] == cases


def test_typed_fields(spark):
    text = ('{"s": " a ", "n": 7, "d": 2.5, "neg": -5.75, "b": true, "z": null, "o": {"x": 1, "t": "9", "y": {"k": 3}}, '
            '"l": [1, "two", {"q": 2}], "big": 1e30, "blank": " "}')
    body = parse_json(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(
        text_field(body, "s").alias("a"), text_field(body, "n").alias("b"), text_field(body, "b", "def").alias("c"),
        string_field(body, "s").alias("d"), string_field(body, "n", "def").alias("e"), double_field(body, "d").alias("f"),
        double_field(body, "s", 0.5).alias("g"), long_field(body, "neg").alias("h"), long_field(body, "big", -1).alias("i"),
        long_field(body, "o.y.k").alias("j"), long_field(body, "o.t").alias("k"), bool_field(body, "b").alias("l"),
        bool_field(body, "n", False).alias("m"), text_field(body, "z", "none").alias("n"), double_field(body, "n.x").alias("o"),
        F.size(elements(body, "l")).alias("p"), F.size(elements(body, "o")).alias("q"), F.size(elements(body, "s")).alias("r"),
        string_field(body, "blank", "def").alias("t2"), long_field(body, "d").alias("u")).first()
    assert tuple(row) == (" a ", "7", "def", "a", "def", 2.5, 0.5, -5, -1, 3, None, True, False, "none", None, 3, 1, 0, "def", 2)


GPU = {"backend": "cuda", "device": "NVIDIA L4", "elements": 1000000, "stats": {"mean": 0.0, "stddev": 1.0},
       "timing_ms": {"kernel_ms": 4.2}, "wall_ms": 120.0}
RUNS = [{"pipeline": "rdd", "run_id": "r1", "groups": 5000, "anomalies": 200, "median_s": 42.0},
        {"pipeline": "dataframe", "run_id": "r2", "groups": 5000, "anomalies": 200, "median_s": 14.0, "output_uri": "s3://o"}]


def events(spark):
    request = {"datasetUri": " s3://bucket/data.parquet ", "outputUri": "s3://out/"}
    full = [("a", "job_accepted", None, None, None, json.dumps({"datasetUri": "old"})),
            ("a", "input_validated", None, None, None, json.dumps(request)), ("a", "gpu_completed", None, None, None, json.dumps(GPU)),
            ("a", "stage_retry_scheduled", "spark", 2, "HTTP 503"), ("a", "spark_completed", None, None, None, json.dumps(RUNS))]
    cpu = [("b", "job_accepted", None, None, None, '{"mode": "zscore"}'),
           ("b", "gpu_completed", None, None, None, '{"backend": "openmp", "stats": 3, "elements": "12"}'),
           ("b", "spark_completed", None, None, None, json.dumps(RUNS[0] | {"anomalies": 4000}))]
    bad = [("c", "job_accepted", None, None, None, "{bad"), ("c", "gpu_completed", None, None, None, "{bad"),
           ("c", "job_failed", "gpu", None, "boom"), ("d", "gpu_completed", None, None, None, "[1]")]
    return log(spark, *full, *cpu, *bad)


def test_typed_jobs_and_analysis(spark):
    jobs = {r.job_id: r for r in typed_jobs(events(spark)).collect()}
    a = jobs["a"]
    assert (a.request.datasetUri, a.request.mode, a.request.pipeline, a.request.forceCpu, a.request.column) == (
        "s3://bucket/data.parquet", "zscore", "both", False, None)
    assert tuple(a.gpu) == ("cuda", "NVIDIA L4", 1000000, 0.0, 1.0, 4.2, 120.0, "s3://out/")
    assert [tuple(r) for r in a.spark] == [("rdd", "r1", 5000, 200, 42.0, None), ("dataframe", "r2", 5000, 200, 14.0, "s3://o")]
    assert a.attempts == {"spark": 2} and a.error == "reintento 2 en spark: HTTP 503"
    b = jobs["b"]
    assert b.request is None and (b.gpu.backend, b.gpu.device, b.gpu.elements, b.gpu.outputUri) == ("openmp", "unknown", 0, "")
    assert math.isnan(b.gpu.mean) and [r.pipeline for r in b.spark] == ["rdd"]
    assert jobs["c"].gpu is None and jobs["c"].request is None and jobs["c"].error == "[gpu] boom" and jobs["c"].spark == []
    assert jobs["d"].gpu.backend == "unknown"
    found = {r.job_id: r for r in analyze_folded(typed_jobs(events(spark))).collect()}
    assert set(found) == {"a", "b", "d"}
    assert (found["a"].speedup, found["a"].anomaly_rate, found["a"].total_s, found["a"].warnings) == (3.0, 0.04, 4.0, [])
    assert found["a"].verdict == "DataFrame es 3.00x más rápido que RDD"
    assert found["b"].speedup is None and found["b"].anomaly_rate == 0.8 and len(found["b"].warnings) == 2


def test_status_round_trip(spark):
    jobs = typed_jobs(events(spark))
    texts = encode_status(jobs)
    plain = {r.job_id: json.loads(r.status) for r in texts.collect()}
    assert list(plain["a"]) == ["jobId", "stage", "createdAt", "updatedAt", "attempts", "request", "gpu", "spark", "error"]
    assert plain["a"]["createdAt"] == "2024-01-01T00:00:00Z" and plain["a"]["attempts"] == {"spark": 2}
    assert plain["a"]["gpu"]["kernelMs"] == 4.2 and "mean" not in plain["b"]["gpu"] and plain["c"]["spark"] == []
    want = {r.job_id: r for r in jobs.drop("spark_at").collect()}
    got = {r.job_id: r.decoded for r in decode_status(texts, "status", "string").collect()}
    for job, row in want.items():
        assert str(tuple(row)) == str(tuple(got[job]))  # as text: NaN equals itself there
    # What a service prints, with optional fields and null numbers; and malformed texts.
    rows = [('{"jobId":"x","stage":"gpu","createdAt":"2026-01-01T00:00:00Z","updatedAt":"2026-01-01T00:00:00.250Z","attempts":{},'
             '"gpu":{"backend":"cuda","device":"d","elements":1,"mean":null,"stddev":null,"kernelMs":0,"wallMs":1.5,"outputUri":""},'
             '"spark":[]}',), ("{bad",), ("x",), (None,), ('{"createdAt": "x"}',)]
    first, *others = [r.decoded for r in decode_status(spark.createDataFrame(rows, "t string"), "t", "string").collect()]
    assert first.updated_at == datetime(2026, 1, 1) + timedelta(milliseconds=250) and math.isnan(first.gpu.mean)
    assert first.request is None and first.analysis is None
    assert all(o.job_id is None and o.created_at is None and o.gpu is None for o in others)


def test_events_given_twice_and_ties(spark):
    df = log(spark, ("a", "job_accepted", None, None, None, '{"datasetUri": "u"}'), ("a", "stage_retry_scheduled", "gpu", 1, "x"))
    twice = df.unionByName(df).unionByName(df.withColumn("payload", F.lit('{"datasetUri": "v"}')))
    row = typed_jobs(twice).first()
    assert row.request.datasetUri == "v" and row.attempts == {"gpu": 1} and row.created_at == T0
    assert typed_jobs(df.limit(0)).count() == 0
