"""Dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import HOT_KEYS, attach_by_key
from ..schema import UNKNOWN_REGION, region_dim


def enrich(df: DataFrame, dim: DataFrame | None = None, on: str = "region",
           unmatched: str = "default", defaults: dict | None = None, large: bool = False,
           hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join to a dimension; unmatched rows get ``defaults`` or NULLs.

    The built-in region dimension has eight rows and is broadcast. A dimension passed in is
    not hinted: its size is unknown here, so Spark's own size check picks the join. ``large`` is for
    a dimension that can't be broadcast while some keys may hold much of the rows: the rows of each
    key are counted first, heavy keys then meet a bounded broadcast and only the others are shuffled.
    """
    if unmatched not in ("default", "null"):
        raise ValueError(f"unmatched must be 'default' or 'null', got {unmatched!r}")
    if dim is None:
        dim = F.broadcast(region_dim(df.sparkSession))
        defaults = UNKNOWN_REGION if defaults is None else defaults
    filled = defaults if unmatched == "default" and defaults else {}
    dim = dim.withColumn("__matched", F.lit(True))
    if large:
        counts = df.groupBy(on).agg(F.count(F.lit(1)).alias("__rows"))
        joined = attach_by_key(df, counts.join(dim, on, "left"), [on], "__rows", hot_keys).drop("__rows")
    else:
        joined = df.join(dim, on, "left")
    joined = joined.withColumns({
        c: F.when(F.col("__matched"), F.col(c)).otherwise(F.lit(v)) for c, v in filled.items()})
    return joined.select(*df.columns, *[c for c in dim.columns if c not in (on, "__matched")])
