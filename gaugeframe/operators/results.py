"""Typed results of a job's stages, its analysis, and its whole status as JSON and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import parse_instant, print_instant
from ..functions.status import analysis_of
from ..functions.typed_json import (bool_field, double_field, elements, long_field, parse_json, string_field,
                                    text_field)
from .jobs import elapsed_seconds, fold_with_times

# The fields of the records in a job's status, and their names in JSON.
REQUEST = "datasetUri string, mode string, pipeline string, outputUri string, callbackUrl string, forceCpu boolean, column string"
GPU = ("backend string, device string, elements bigint, mean double, stddev double, kernelMs double, wallMs double, "
       "outputUri string")
RUN = "pipeline string, runId string, groups bigint, anomalies bigint, medianSeconds double, outputUri string"
ANALYSIS = ("anomalyRate double, rddSeconds double, dataFrameSeconds double, sparkSpeedup double, gpuBackend string, "
            "totalSeconds double, verdict string, warnings array<string>")
STATUS = ("jobId {id}, stage string, createdAt string, updatedAt string, attempts map<string,int>, "
          f"request struct<{REQUEST}>, gpu struct<{GPU}>, spark array<struct<{RUN}>>, analysis struct<{ANALYSIS}>, error string")
NAN = float("nan")


def request_record(payload: Column) -> Column:
    """The request of a payload with its defaults; NULL without a dataset."""
    body = parse_json(payload)
    record = F.struct(
        string_field(body, "datasetUri").alias("datasetUri"), string_field(body, "mode", "zscore").alias("mode"),
        string_field(body, "pipeline", "both").alias("pipeline"), string_field(body, "outputUri").alias("outputUri"),
        string_field(body, "callbackUrl").alias("callbackUrl"), bool_field(body, "forceCpu", False).alias("forceCpu"),
        string_field(body, "column").alias("column"))
    return F.when(string_field(body, "datasetUri").isNotNull(), record)


def gpu_record(payload: Column, output_uri: Column) -> Column:
    """The normalisation result of a service's answer; NULL for malformed JSON. ``output_uri``
    stands in where the answer names none."""
    body = parse_json(payload)
    record = F.struct(
        text_field(body, "backend", "unknown").alias("backend"), text_field(body, "device", "unknown").alias("device"),
        long_field(body, "elements", 0).alias("elements"), double_field(body, "stats.mean", NAN).alias("mean"),
        double_field(body, "stats.stddev", NAN).alias("stddev"),
        double_field(body, "timing_ms.kernel_ms", 0.0).alias("kernelMs"), double_field(body, "wall_ms", 0.0).alias("wallMs"),
        F.coalesce(text_field(body, "output_uri"), output_uri, F.lit("")).alias("outputUri"))
    return F.when(body.isNotNull(), record)


def run_records(payload: Column) -> Column:
    """The runs of a launcher's answers, in their order; none for malformed JSON."""
    return F.coalesce(F.transform(elements(parse_json(payload)), lambda run: F.struct(
        text_field(run, "pipeline", "").alias("pipeline"), text_field(run, "run_id", "").alias("runId"),
        long_field(run, "groups", 0).alias("groups"), long_field(run, "anomalies", 0).alias("anomalies"),
        double_field(run, "median_s", 0.0).alias("medianSeconds"), text_field(run, "output_uri").alias("outputUri"))),
        F.array().cast(f"array<struct<{RUN}>>"))


def analysis_record(payload: Column) -> Column:
    """A recorded analysis; NULL for malformed JSON."""
    body = parse_json(payload)
    warnings = F.array_compact(F.transform(elements(body, "warnings"), lambda w: text_field(w, "")))
    record = F.struct(
        double_field(body, "anomalyRate", 0.0).alias("anomalyRate"), double_field(body, "rddSeconds").alias("rddSeconds"),
        double_field(body, "dataFrameSeconds").alias("dataFrameSeconds"), double_field(body, "sparkSpeedup").alias("sparkSpeedup"),
        text_field(body, "gpuBackend", "unknown").alias("gpuBackend"), double_field(body, "totalSeconds", 0.0).alias("totalSeconds"),
        text_field(body, "verdict", "").alias("verdict"), warnings.alias("warnings"))
    return F.when(body.isNotNull(), record)


def typed_jobs(events: DataFrame) -> DataFrame:
    """``fold_jobs`` with typed records: (job_id, stage, created_at, updated_at, attempts, request,
    gpu, spark, analysis, error, spark_at). ``spark_at`` is when the runs were last reported."""
    state = fold_with_times(events)
    request = request_record(F.col("request"))
    return state.withColumn("request", request).select(
        "job_id", "stage", "created_at", "updated_at", "attempts", "request",
        gpu_record(F.col("gpu"), F.col("request.outputUri")).alias("gpu"), run_records(F.col("runs")).alias("spark"),
        analysis_record(F.col("analysis")).alias("analysis"), "error", "spark_at")


def analyze_folded(jobs: DataFrame, rate_base: str = "groups") -> DataFrame:
    """The analysis of each job of ``typed_jobs`` that has a normalisation result, as the job
    itself makes it: from its record and runs, row by row. Its seconds go from creation to the
    report of the runs, or the last event without one."""
    total = elapsed_seconds(F.col("created_at"), F.coalesce("spark_at", "updated_at"))
    record = analysis_of(F.col("spark"), F.col("gpu.backend"), total, rate_base)
    return jobs.filter(F.col("gpu").isNotNull()).select("job_id", record.alias("a")).select(
        "job_id", F.col("a.anomalyRate").alias("anomaly_rate"), F.col("a.rddSeconds").alias("rdd_s"),
        F.col("a.dataFrameSeconds").alias("dataframe_s"), F.col("a.sparkSpeedup").alias("speedup"),
        F.col("a.gpuBackend").alias("backend"), F.col("a.totalSeconds").alias("total_s"), "a.verdict", "a.warnings")


def _finite(value: Column) -> Column:
    """JSON has no NaN: such a number is left out, and reads as NaN again."""
    return F.when(~F.isnan(value), value)


def encode_status(jobs: DataFrame) -> DataFrame:
    """``job_id, status``: all ten fields of a job's status as JSON, instants as Java prints them.
    Fields without a value are left out."""
    gpu = F.when(F.col("gpu").isNotNull(), F.col("gpu").withField("mean", _finite(F.col("gpu.mean")))
                 .withField("stddev", _finite(F.col("gpu.stddev"))))
    body = F.struct(F.col("job_id").alias("jobId"), "stage", print_instant("created_at").alias("createdAt"),
                    print_instant("updated_at").alias("updatedAt"), "attempts", "request", gpu.alias("gpu"), "spark",
                    "analysis", "error")
    return jobs.select("job_id", F.to_json(body).alias("status"))


def decode_status(df: DataFrame, json_col: str, id_type: str = "bigint") -> DataFrame:
    """The columns of ``df`` and a struct ``decoded`` with the typed fields of a status; all of
    them NULL for a malformed text."""
    body = F.from_json(json_col, STATUS.format(id=id_type))
    gpu = body["gpu"]
    gpu = F.when(gpu.isNotNull(), gpu.withField("mean", F.coalesce(gpu["mean"], F.lit(NAN)))
                 .withField("stddev", F.coalesce(gpu["stddev"], F.lit(NAN))))
    return df.withColumn("decoded", F.struct(
        body["jobId"].alias("job_id"), body["stage"].alias("stage"), parse_instant(body["createdAt"]).alias("created_at"),
        parse_instant(body["updatedAt"]).alias("updated_at"), body["attempts"].alias("attempts"),
        body["request"].alias("request"), gpu.alias("gpu"), body["spark"].alias("spark"),
        body["analysis"].alias("analysis"), body["error"].alias("error")))
