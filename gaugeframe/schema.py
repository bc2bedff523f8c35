"""Table schemas and business constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The columns of the tables in files.
TELEMETRY = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("ts", T.LongType(), False),
    T.StructField("value", T.DoubleType()),
    T.StructField("value_norm", T.DoubleType()),
    T.StructField("quality", T.IntegerType()),
])

REGION_DIM = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("continent", T.StringType()),
    T.StructField("sla_ms", T.IntegerType()),
    T.StructField("tier", T.StringType()),
])

BENCH = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("impl", T.StringType()),
    T.StructField("threads", T.IntegerType()),
    T.StructField("ms_mediana", T.DoubleType()),
    T.StructField("ms_min", T.DoubleType()),
    T.StructField("gbps", T.DoubleType()),
    T.StructField("h2d_ms", T.DoubleType()),
    T.StructField("kernel_ms", T.DoubleType()),
    T.StructField("d2h_ms", T.DoubleType()),
    T.StructField("speedup_vs_1t", T.DoubleType()),
    T.StructField("err_rel_max", T.DoubleType()),
])

PROFILE = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("readings", T.LongType()),
    T.StructField("mean_norm", T.DoubleType()),
    T.StructField("stddev_norm", T.DoubleType()),
    T.StructField("min_norm", T.DoubleType()),
    T.StructField("max_norm", T.DoubleType()),
    T.StructField("anomalies", T.LongType()),
    T.StructField("anomaly_ratio", T.DoubleType()),
    T.StructField("continent", T.StringType()),
    T.StructField("sla_ms", T.IntegerType()),
    T.StructField("tier", T.StringType()),
])

RUN_METRICS = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("runs", T.IntegerType()),
    T.StructField("times_s", T.ArrayType(T.DoubleType())),
    T.StructField("median_s", T.DoubleType()),
    T.StructField("min_s", T.DoubleType()),
    T.StructField("groups", T.LongType()),
    T.StructField("anomalies", T.LongType()),
    T.StructField("top", T.ArrayType(PROFILE)),
    T.StructField("spark_version", T.StringType()),
])

# Thresholds and tolerances that decide the results.
QUALITY_THRESHOLD = 60
ANOMALY_SIGMA = 3.0
TOP_K = 20
TOP_CHECKED = 5
SPREAD_EPSILON = 1e-12
EQUIVALENCE_TOLERANCE = 1e-6
RELATIVE_ERROR_FLOOR = 1e-6
HIGH_ANOMALY_RATE = 0.05
RETENTION_DAYS = 30
RECENT_JOBS = 100

# The region dimension and the row for regions it lacks.
REGIONS = [
    ("eu-west", "EU", 250, "gold"),
    ("eu-north", "EU", 300, "silver"),
    ("us-east", "NA", 200, "gold"),
    ("us-west", "NA", 220, "gold"),
    ("sa-east", "SA", 400, "bronze"),
    ("ap-south", "AS", 350, "silver"),
    ("ap-north", "AS", 320, "silver"),
    ("af-south", "AF", 500, "bronze"),
]
UNKNOWN_REGION = {"continent": "??", "sla_ms": 999, "tier": "unknown"}

# Domains of the job records.
MODES = ["minmax", "zscore", "robust"]
PIPELINES = ["rdd", "dataframe", "both"]
URI_SCHEMES = ["s3", "s3a", "gs", "hdfs", "file", "abfss"]
STAGES = ["received", "validating", "gpu", "spark", "analyzing", "responding",
          "completed", "failed"]


def region_dim(spark: SparkSession) -> DataFrame:
    """The eight known regions as a literal relation (no job, size known to the planner)."""
    rows = ", ".join(f"('{r}', '{c}', {s}, '{t}')" for r, c, s, t in REGIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS d(region, continent, sla_ms, tier)")
