"""Seeded telemetry: every column is a hash of (row id, seed), so partitioning never changes it."""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sampling import PRIME, permuted

# Shape of the generated telemetry.
REGION_WEIGHTS = [
    ("eu-west", 0.25), ("eu-north", 0.08), ("us-east", 0.30), ("us-west", 0.12),
    ("sa-east", 0.06), ("ap-south", 0.10), ("ap-north", 0.06), ("af-south", 0.03),
]
VALUE_MEAN, VALUE_STDDEV = 100.0, 25.0
SHIFT_LOW, SHIFT_HIGH = 100.0, 200.0
QUALITY_MEAN, QUALITY_STDDEV = 80.0, 18.0
SPAN_SECONDS = 86_400 * 30
BLOCK_ROWS = 2_000_000


def _uniform(row: Column, seed: int, draw: int) -> Column:
    """Uniform in (0, 1): the top 53 bits of a hash, moved off zero."""
    bits = F.shiftrightunsigned(F.xxhash64(row, F.lit(seed), F.lit(draw)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _normal(row: Column, seed: int, draw: int) -> Column:
    radius = F.sqrt(-2.0 * F.ln(_uniform(row, seed, draw)))
    return radius * F.cos(2.0 * math.pi * _uniform(row, seed, draw + 1))


def _integer(u: Column, below: int) -> Column:
    return F.least(F.floor(u * below), F.lit(below - 1)).cast("long")


def telemetry_from_ids(df: DataFrame, id_col: str, sensors: int = 5_000,
                       anomaly_rate: float = 0.004, seed: int = 42, base_ts: int = 0,
                       outlier: Column | None = None) -> DataFrame:
    """One telemetry row per id. ``outlier`` says which rows are shifted; by default each row
    is one with probability ``anomaly_rate``."""
    row = F.col(id_col)
    if outlier is None:
        outlier = _uniform(row, seed, 0) < anomaly_rate

    edge, u = 0.0, _uniform(row, seed, 1)
    region = F
    for name, weight in REGION_WEIGHTS[:-1]:
        edge += weight
        region = region.when(u < round(edge, 10), F.lit(name))
    region = region.otherwise(F.lit(REGION_WEIGHTS[-1][0]))

    sign = F.when(_uniform(row, seed, 5) < 0.5, -1.0).otherwise(1.0)
    shift = sign * (SHIFT_LOW + (SHIFT_HIGH - SHIFT_LOW) * _uniform(row, seed, 6))
    quality = QUALITY_MEAN + QUALITY_STDDEV * _normal(row, seed, 7)
    return (df
            .withColumn("__value", VALUE_MEAN + VALUE_STDDEV * _normal(row, seed, 3)
                        + F.when(outlier, shift).otherwise(0.0))
            .select(
                F.format_string("S%06d", _integer(_uniform(row, seed, 2), sensors)).alias("sensor_id"),
                region.alias("region"),
                (F.lit(base_ts).cast("long")
                 + _integer(_uniform(row, seed, 9), SPAN_SECONDS)).alias("ts"),
                F.col("__value").alias("value"),
                ((F.col("__value") - VALUE_MEAN) / VALUE_STDDEV).alias("value_norm"),
                F.least(F.greatest(quality, F.lit(0.0)), F.lit(100.0)).cast("int").alias("quality"),
            ))


def block_outlier(number: Column, rows: Column, anomaly_rate: float = 0.004, seed: int = 42,
                  block_rows: int = BLOCK_ROWS) -> Column:
    """Whether a row, numbered from 0 to ``rows`` - 1, is an outlier: in each block of
    ``block_rows`` rows a random sample of exactly ``int(size * anomaly_rate)`` is."""
    if not 0 < block_rows < PRIME:
        raise ValueError(f"block_rows must be in 1..{PRIME - 1}")
    block = F.floor(number / block_rows).cast("bigint")
    size = F.least(F.lit(block_rows).cast("bigint"), rows - block * block_rows)
    place = permuted(number % block_rows, size, block * 7_919 + F.lit(seed))
    return place < F.floor(size * anomaly_rate)


def generate_telemetry(spark: SparkSession, rows: int, sensors: int = 5_000,
                       anomaly_rate: float = 0.004, seed: int = 42, base_ts: int | None = None,
                       block_rows: int = BLOCK_ROWS, partitions: int | None = None) -> DataFrame:
    """``rows`` telemetry rows with exactly ``int(size * anomaly_rate)`` outliers per block, at
    random places, without a sort or a shuffle."""
    if base_ts is None:
        base_ts = int(time.time()) - SPAN_SECONDS
    outlier = block_outlier(F.col("id"), F.lit(rows), anomaly_rate, seed, block_rows)
    return telemetry_from_ids(spark.range(0, rows, 1, partitions), "id", sensors, anomaly_rate,
                              seed, base_ts, outlier)
