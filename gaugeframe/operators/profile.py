"""Anomaly profile: quality filter, per-group statistics, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import is_anomaly, null_policy_value
from ..schema import ANOMALY_SIGMA, QUALITY_THRESHOLD, TOP_K

GROUP_KEYS = ["region", "sensor_id"]


def filter_quality(df: DataFrame, threshold: int = QUALITY_THRESHOLD) -> DataFrame:
    """Rows of at least this quality; NULL quality is dropped. Reaches the Parquet scan."""
    return df.filter(F.col("quality") >= threshold)


def project_profile_input(df: DataFrame, keys: list[str] | None = None,
                          value: str = "value_norm") -> DataFrame:
    """Only the columns a profile reads."""
    return df.select(*(keys or GROUP_KEYS), value, "quality")


def anomaly_profile(df: DataFrame, keys: list[str] | None = None, value: str = "value_norm",
                    sigma: float = ANOMALY_SIGMA, null_policy: str = "skip") -> DataFrame:
    """Per group: readings, mean, population stddev, min, max, anomalies and their ratio.

    One shuffle of partial aggregates: a hot group costs each map task one row.
    """
    x = null_policy_value(value, null_policy)
    return (df.groupBy(*(keys or GROUP_KEYS))
            .agg(F.count(F.lit(1)).alias("readings"),
                 F.avg(x).alias("mean_norm"),
                 F.stddev_pop(x).alias("stddev_norm"),
                 F.min(x).alias("min_norm"),
                 F.max(x).alias("max_norm"),
                 F.count_if(is_anomaly(x, sigma)).alias("anomalies"))
            .withColumn("anomaly_ratio", F.col("anomalies") / F.col("readings")))


def profile_totals(profile: DataFrame) -> DataFrame:
    """Number of groups and all their anomalies, 0 for an empty profile."""
    return profile.agg(F.count(F.lit(1)).alias("groups"),
                       F.coalesce(F.sum("anomalies"), F.lit(0)).cast("long").alias("anomalies"))


def top_anomalies(profile: DataFrame, k: int = TOP_K,
                  keys: list[str] | None = None) -> DataFrame:
    """The ``k`` groups with the highest ratio, then most readings; the keys break ties."""
    return (profile.orderBy(F.col("anomaly_ratio").desc(), F.col("readings").desc(),
                            *(keys or GROUP_KEYS))
            .limit(k))
