from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gaugeframe.functions import failure_retryable, run_family
from gaugeframe.operators import (accept_starts, fold_jobs, job_attempts, job_counts, lookup_job,
                                  recent_jobs, retain)

SCHEMA = ("job_id string, seq long, at timestamp_ntz, event_type string, stage string, attempt int, "
          "reason string, payload string")
T0 = datetime(2024, 1, 1)


def log(spark, *events):
    rows = []
    for seq, (job, kind, *rest) in enumerate(events):
        stage, attempt, reason, payload = (rest + [None] * 4)[:4]
        rows.append((job, seq, T0 + timedelta(seconds=seq), kind, stage, attempt, reason, payload))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_full_path(spark):
    df = log(spark, ("j", "job_accepted", None, None, None, "r0"), ("j", "input_validated", None, None, None, "r1"),
             ("j", "gpu_completed", None, None, None, "g"), ("j", "spark_completed", None, None, None, "s"),
             ("j", "analysis_completed", None, None, None, "a"), ("j", "response_delivered"))
    row = fold_jobs(df, now=F.lit(T0 + timedelta(milliseconds=7500)).cast("timestamp_ntz")).first()
    assert (row["stage"], row["is_terminal"], row["request"], row["gpu"], row["runs"], row["analysis"]) == (
        "completed", True, "r1", "g", "s", "a")
    assert (row["created_at"], row["updated_at"], row["elapsed_s"]) == (T0, T0 + timedelta(seconds=5), 7.5)
    assert row["error"] is None and row["attempts"] == {}


def test_retry_keeps_the_stage_and_failure_ends_it(spark):
    df = log(spark, ("a", "job_accepted"), ("a", "input_validated"),
             ("a", "stage_retry_scheduled", "gpu", 1, "HTTP 503"), ("a", "stage_retry_scheduled", "gpu", 2, "HTTP 503"),
             ("b", "job_accepted"), ("b", "job_failed", "validating", None, "bad"), ("c", "something_else"))
    got = {r["job_id"]: r for r in fold_jobs(df).collect()}
    assert (got["a"]["stage"], got["a"]["attempts"], got["a"]["is_terminal"]) == ("gpu", {"gpu": 2}, False)
    assert got["a"]["error"] == "reintento 2 en gpu: HTTP 503"
    assert (got["b"]["stage"], got["b"]["error"], got["b"]["is_terminal"]) == ("failed", "[validating] bad", True)
    assert got["c"]["stage"] == "received"


def test_unknown_stages_stay_apart(spark):
    df = log(spark, ("a", "stage_retry_scheduled", "nowhere", 3, "x"), ("a", "stage_retry_scheduled", "else", 2, "x"),
             ("a", "stage_retry_scheduled", "spark", 1, "x"))
    assert fold_jobs(df).first()["attempts"] == {"nowhere": 3, "else": 2, "spark": 1}
    assert {(r["stage"], r["attempts"]) for r in job_attempts(df).collect()} == {
        ("nowhere", 3), ("else", 2), ("spark", 1)}


def test_recent_lookup_retain(spark):
    jobs = spark.createDataFrame([(j, T0 + timedelta(days=d)) for j, d in
                                  (("a", 0), ("b", 2), ("c", 2), ("d", 1))], "job_id string, updated_at timestamp_ntz")
    assert [r[0] for r in recent_jobs(jobs, 3).collect()] == ["b", "c", "d"]
    assert lookup_job(jobs, "d").count() == 1 and lookup_job(jobs, "x").count() == 0
    now = F.lit(T0 + timedelta(days=31)).cast("timestamp_ntz")
    assert {r[0] for r in retain(jobs, now=now).collect()} == {"b", "c"}


def test_first_start_wins(spark):
    rows = [("a", 2, T0), ("a", 1, T0), ("a", 0, T0 + timedelta(seconds=1)), ("b", 5, T0)]
    starts = spark.createDataFrame(rows, "job_id string, seq long, at timestamp_ntz")
    assert {(r["job_id"], r["seq"], r["rejected"]) for r in accept_starts(starts).collect()} == {("a", 1, 2), ("b", 5, 0)}


def test_counts_and_families(spark):
    df = spark.createDataFrame([("SUCCESS",), ("completed",), ("Failed",), ("CANCELLED",), ("CANCELLING",),
                                ("RUNNING",), ("queued",), (None,)], "state string")
    assert [r[0] for r in df.select(run_family("state")).collect()] == (
        ["success"] * 2 + ["failed"] * 3 + ["pending"] * 3)
    assert tuple(job_counts(df).first()) == (8, 1)


def test_failure_triage(spark):
    cases = [("java.util.concurrent.TimeoutException", None, True), ("java.net.ConnectException", "x", True),
             ("java.net.UnknownHostException", "timeout", False), ("NonRetryable", "HTTP 503", False),
             ("java.io.UncheckedIOException", "x", False), ("java.io.UncheckedIOException", "read timeout", True),
             ("java.io.IOException", "", True), ("java.lang.RuntimeException", "a HTTP 503", True),
             ("java.lang.RuntimeException", "a HTTP 429", True), ("java.lang.RuntimeException", "a HTTP 404", False),
             ("java.net.MalformedURLException", "", True), ("java.nio.channels.ClosedChannelException", None, True),
             ("javax.net.ssl.SSLException", "x", True), ("java.lang.OutOfMemoryError", "timeout", False),
             (None, "Connection refused", True), (None, None, False)]
    df = spark.createDataFrame(cases, "c string, m string, want boolean")
    assert df.filter(~failure_retryable("c", "m").eqNullSafe(F.col("want"))).collect() == []
