"""Reading telemetry. Paths are Hadoop URIs (s3, s3a, gs, hdfs, file, abfss or local)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import TELEMETRY


def read_telemetry(spark: SparkSession, path: str | list[str], format: str = "parquet",
                   schema: T.StructType | None = TELEMETRY) -> DataFrame:
    """Parquet with its own schema, or CSV with a header checked against ``schema``.

    ``schema=None`` infers the CSV types, for files that are not telemetry.
    """
    if format == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    if format != "csv":
        raise ValueError(f"format must be 'parquet' or 'csv', got {format!r}")
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # enforceSchema binds columns by position; checking the header refuses swapped columns.
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def pick_column(df: DataFrame, column: str | None = None, default: str = "first_numeric") -> str:
    """Name of the column to work on: the one asked for, else ``first`` or ``first_numeric``,
    else a column called ``default`` itself."""
    if column is not None:
        if column not in df.columns:
            raise ValueError(f"no column {column!r} in {df.columns}")
        return column
    if default == "first":
        return df.columns[0]
    if default == "first_numeric":
        for field in df.schema.fields:
            if isinstance(field.dataType, T.NumericType):
                return field.name
        raise ValueError("no numeric column")
    return pick_column(df, default)
