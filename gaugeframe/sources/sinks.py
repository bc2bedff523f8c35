"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_profile(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_normalized(df: DataFrame, path: str) -> None:
    """The whole table with its normalised column, so a profile can be run on the output."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    if format == "parquet":
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    elif format == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"format must be 'parquet' or 'csv', got {format!r}")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append run records (see ``operators.runs.metrics_record``) as JSON lines."""
    metrics.write.mode("append").option("ignoreNullFields", False).json(path)
