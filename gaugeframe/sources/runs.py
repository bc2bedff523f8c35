"""Run tables: benchmark CSV rows and per-run metrics JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BENCH, RUN_METRICS


def read_bench(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BENCH).option("header", True).option("enforceSchema", False).csv(path)


def read_metrics(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Metrics records; ``multi_line=False`` for the JSON-lines files ``write_metrics`` leaves,
    which Spark can split."""
    return spark.read.schema(RUN_METRICS).option("multiLine", multi_line).json(path)


def read_runs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per timed run: pipeline, input, run (0-based), seconds, groups, anomalies."""
    metrics = read_metrics(spark, path, multi_line)
    return metrics.select("pipeline", "input", F.posexplode("times_s").alias("run", "seconds"),
                          "groups", "anomalies")
