"""Views of the star-schema tables as telemetry, runs, requests and job logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import epoch_seconds

REGION_OF_EVENT = {"click": "us-east", "view": "eu-west", "purchase": "ap-south",
                   "error": "af-south"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ladder(key: Column, values: dict, default) -> Column:
    out = F
    for k, v in values.items():
        out = out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sensor readings, with NULL values, NULL qualities and an unknown region."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("sensor_id"),
        _ladder(F.col("event_type"), REGION_OF_EVENT, "xx-lab").alias("region"),
        epoch_seconds("ts").alias("ts"),
        F.when(event % 97 != 0, F.col("value")).alias("value"),
        F.when(event % 89 != 0, (event * 37 % 101).cast("int")).alias("quality"))


def line_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as readings of suppliers."""
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_extendedprice").alias("value"),
        (F.col("l_quantity") * 2).cast("int").alias("quality"))


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier -> region name. Nation and region are fixed tables of 25 and 5 rows."""
    nations = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return (table(spark, sf_dir, "supplier")
            .join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as runs of one pipeline, views as runs of the other; a job per user."""
    return (table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
            .select(F.col("user_id").alias("job_id"), F.col("event_id").alias("run_id"),
                    _ladder(F.col("event_type"), {"click": "rdd"}, "dataframe").alias("pipeline"),
                    F.col("value").alias("seconds")))


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their group and anomaly counts; now and then a run disagrees on the groups."""
    run = F.col("run_id")
    return runs(spark, sf_dir).select(
        "job_id", "pipeline", "run_id",
        (1000 + F.when(run % 50 == 0, 1).otherwise(0)).cast("long").alias("groups"),
        (run % 80).alias("anomalies"), (run % 80 * 1000 + 1).alias("readings"),
        F.col("seconds").alias("median_s"))


def job_backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One normalisation result per job."""
    return (table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("job_id"))
            .agg(F.max("value").alias("total_s"))
            .withColumn("backend", F.when(F.col("job_id") % 3 == 0, "cuda").otherwise("openmp")))


def bench_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as benchmark rows: one thread, eight threads, accelerated; a size per user."""
    kind, ms = F.col("event_type"), F.col("value")
    return (table(spark, sf_dir, "events").filter(kind.isin("click", "view", "purchase"))
            .select(F.col("user_id").alias("n"),
                    F.when(kind == "purchase", "gpu_cuda").otherwise("cpu_omp").alias("impl"),
                    _ladder(kind, {"click": 1, "view": 8}, 4).cast("int").alias("threads"),
                    ms.alias("ms_mediana"), (ms * 0.5).alias("ms_min"),
                    F.lit(0.0).alias("gbps"), (ms * 0.25).alias("h2d_ms"),
                    (ms * 0.5).alias("kernel_ms"), (ms * 0.125).alias("d2h_ms"),
                    F.lit(1.0).alias("speedup_vs_1t"), F.lit(0.0).alias("err_rel_max")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests: status, priority and price pick good and bad field values."""
    key = F.col("o_orderkey")
    scheme = _ladder(key % 7, {0: "ftp", 1: "s3", 2: "gs", 3: "hdfs", 4: "s3a", 5: "file"}, "abfss")
    uri = F.concat(scheme, F.lit("://bucket/c"), F.col("o_custkey").cast("string"),
                   F.lit("/data-"), key.cast("string"), F.lit(".parquet"))
    mode = _ladder(F.col("o_orderpriority"),
                   {"1-URGENT": "zscore", "2-HIGH": "minmax", "3-MEDIUM": "robust",
                    "5-LOW": "logaritmica"}, "MINMAX")
    pipeline = (F.when(F.col("o_orderstatus") == "O", "both")
                 .when(F.col("o_orderstatus") == "F", "rdd")
                 .when(F.col("o_totalprice") > 250000, "spark").otherwise("dataframe"))
    return table(spark, sf_dir, "orders").select(
        key.alias("job_id"), F.when(key % 13 != 0, uri).alias("dataset_uri"),
        mode.alias("mode"), pipeline.alias("pipeline"),
        F.when(key % 5 == 0, F.lit("s3://out/")).alias("output_uri"),
        F.when(key % 11 == 1, F.lit("https://hook/x")).when(key % 11 == 2, F.lit("mailto:x"))
        .alias("callback_url"))


def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON request bodies, with every kind of malformed field."""
    key = F.col("o_orderkey")
    uri = F.concat(F.lit('"datasetUri": "s3://b/'), key.cast("string"), F.lit('"'))
    body = _ladder(key % 16, {
        0: "", 1: ', "mode": "minmax"', 2: ', "mode": " robust "', 3: ', "mode": "  "',
        4: ', "mode": 5', 5: ', "mode": null', 6: ', "pipeline": "rdd", "forceCpu": true',
        7: ', "forceCpu": "yes"', 8: ', "forceCpu": null', 9: ', "column": "value"',
        10: ', "column": false', 11: ', "outputUri": "s3://o/", "callbackUrl": "http://h"',
        12: ', "outputUri": 7, "callbackUrl": ""', 13: ', "unknown": 1'}, ', "mode": "zscore"')
    text = (F.when(key % 19 == 0, F.lit("[1]")).when(key % 19 == 1, F.lit("{bad"))
             .when(key % 19 == 2, F.concat(F.lit('{"x": 1'), body, F.lit("}")))
             .when(key % 19 == 3, F.concat(F.lit('{"datasetUri": 12'), body, F.lit("}")))
             .otherwise(F.concat(F.lit("{"), uri, body, F.lit("}"))))
    return table(spark, sf_dir, "orders").select(key.alias("job_id"), text.alias("body"))


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the event log of jobs; a job per user."""
    event = F.col("event_id")
    late = _ladder(event % 4, {0: "spark_completed", 1: "analysis_completed",
                               2: "response_delivered"}, "job_failed")
    kind = (F.when(F.col("event_type") == "purchase", late)
            .otherwise(_ladder(F.col("event_type"),
                               {"signup": "job_accepted", "click": "input_validated",
                                "view": "gpu_completed"}, "stage_retry_scheduled")))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), event.alias("seq"), F.col("ts").alias("at"),
        kind.alias("event_type"),
        _ladder(event % 7, {0: "gpu", 1: "spark", 2: "warmup", 3: "drain"}, "analyzing").alias("stage"),
        (event % 5 + 1).cast("int").alias("attempt"),
        F.concat(F.lit("HTTP "), (500 + event % 4).cast("string")).alias("reason"),
        F.col("props").alias("payload"))


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs in some launcher state."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("job_id"),
        _ladder(F.col("event_type"), {"click": "RUNNING", "view": "success",
                                      "purchase": "Completed", "error": "CANCELLING"}, None)
        .alias("state"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as a failure log."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        _ladder(event % 9, {0: "java.net.SocketTimeoutException", 1: "NonRetryable",
                            2: "java.net.UnknownHostException", 3: "java.io.IOException",
                            4: "java.net.MalformedURLException", 5: "javax.net.ssl.SSLException",
                            6: "java.lang.OutOfMemoryError", 7: "com.example.StorageIOException"},
                "java.lang.RuntimeException").alias("error_class"),
        F.when(event % 7 == 0, F.lit("read timeout"))
        .otherwise(F.concat(F.lit("launcher HTTP "), (400 + event % 4 * 43).cast("string")))
        .alias("message"))


def _pick(of: Column, choices: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (of % len(choices) + 1).cast("int"))


# JSON texts of stage results, with every kind of malformed field. @ stands for the event's id and
# # for an eighth of it.
REQUEST_TEXTS = ['{"datasetUri": "s3://b/@.parquet", "outputUri": "s3://o/@/", "column": "value"}',
                 '{"datasetUri": " s3://b/@ ", "mode": "minmax", "forceCpu": true}',
                 '{"mode": "robust"}', '{"datasetUri": 5}', '{"datasetUri": "s3://b/@", "pipeline": "rdd", "mode": 7}']
GPU_TEXTS = ['{"backend": "cuda", "device": "L4", "elements": @, "stats": {"mean": 0.5, "stddev": 1}, '
             '"timing_ms": {"kernel_ms": #}, "wall_ms": #, "output_uri": "s3://n/@"}',
             '{"backend": 7, "elements": "12", "stats": 5}', '{"backend": "openmp", "wall_ms": 3}',
             '{"backend": null, "wall_ms": "3", "timing_ms": [1]}', '{bad', '[1, 2]',
             '{"backend": "cuda", "elements": 5.75, "stats": {"mean": "x", "stddev": #}}',
             '{"backend": true, "device": 2.5, "timing_ms": {"kernel_ms": 3}}']
RUN_TEXTS = ['[{"pipeline": "rdd", "run_id": "r@", "groups": 1000, "anomalies": 80, "median_s": #}, '
             '{"pipeline": "dataframe", "run_id": "d@", "groups": 1000, "anomalies": 30, "median_s": 250.5}]',
             '[{"pipeline": "dataframe", "run_id": 9, "groups": 900, "median_s": 0}, {"pipeline": "rdd", "groups": 901, "median_s": 2.5}]',
             '{"pipeline": "rdd", "groups": "10", "anomalies": 5.5, "median_s": "1"}', '"none"', '{bad',
             '[{"pipeline": "dataframe", "groups": 40, "anomalies": 1, "median_s": 4, "output_uri": "s3://o"}, '
             '{"pipeline": "rdd", "median_s": 5}, {"pipeline": "rdd", "median_s": 7}]']
ANALYSIS_TEXTS = ['{"anomalyRate": 0.25, "rddSeconds": 2, "gpuBackend": "cuda", "totalSeconds": #, "verdict": "v@", "warnings": ["a", 5, null]}',
                  '{"anomalyRate": "x", "warnings": "none"}', '[]', '{bad']


def result_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``job_log`` with the stages' results as payloads."""
    event, kind = F.col("seq"), F.col("event_type")
    text = (F.when(kind.isin("job_accepted", "input_validated"), _pick(event, REQUEST_TEXTS))
             .when(kind == "gpu_completed", _pick(event, GPU_TEXTS))
             # These kinds of events fix the id's remainder by 4.
             .when(kind == "spark_completed", _pick(F.floor(event / 4), RUN_TEXTS))
             .when(kind == "analysis_completed", _pick(F.floor(event / 4), ANALYSIS_TEXTS)))
    text = F.replace(F.replace(text, F.lit("@"), event.cast("string")), F.lit("#"), (event / 8).cast("decimal(18,3)").cast("string"))
    return job_log(spark, sf_dir).withColumn("payload", text)


def instant_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as instants in every form, and texts that are none."""
    event, at = F.col("event_id"), F.col("ts")
    whole, micros = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(at, "SSSSSS")
    ends = [F.lit("Z"), F.concat(F.lit("."), F.substring(micros, 1, 3), F.lit("Z")), F.concat(F.lit("."), micros, F.lit("Z")),
            F.concat(F.lit("."), micros, F.lit("789Z")), F.lit("+02:30"), F.lit("-00:45"), F.lit(""), F.lit("Zx")]
    end = ends[-1]
    for i, e in enumerate(ends[:-1]):
        end = F.when(event % len(ends) == i, e).otherwise(end)
    text = F.when(event % 23 == 0, F.concat(F.lit("x"), whole)).otherwise(F.concat(whole, end))
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"))
