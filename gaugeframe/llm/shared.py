"""Intermediate tables that every executor can read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``. Only where that is unset, as in tests on a
    local master, a temporary folder is used."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as a table and read back: it is computed once, and a lost executor
    costs no more than reading it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``used`` under names that nothing else has, and what gives a
    result with these columns their own names again."""
    inner = {c: c if c in used else f"aside__{i}" for i, c in enumerate(df.columns)}
    own = {v: k for k, v in inner.items()}
    return df.toDF(*inner.values()), lambda out: out.toDF(*[own.get(c, c) for c in out.columns])
