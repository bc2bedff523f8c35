"""Normalisation of a numeric column: one statistics pass, then a narrow affine map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import affine, check_mode, clean_number
from ..plans.skew import HOT_KEYS, attach_by_key


def _aggregates(value: Column) -> list[Column]:
    return [
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("stddev"),
        F.sum(value).alias("sum"), F.sum(value * value).alias("sumsq"),
    ]


def column_stats(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """n, min, max, mean, population stddev, sum and sum of squares; one row, or one per key.

    NULL and NaN are left out.
    """
    return df.groupBy(*(by or [])).agg(*_aggregates(clean_number(col)))


def _as_type(value: Column, precision: str) -> Column:
    if precision not in ("double", "float"):
        raise ValueError(f"precision must be 'double' or 'float', got {precision!r}")
    return value.cast(precision)


def _input(col: str, precision: str) -> Column:
    return _as_type(clean_number(col), precision)


def _params(modes: dict[str, str], precision: str) -> list[Column]:
    """One (shift, scale) struct per output column, from a statistics row."""
    out = []
    for i, mode in enumerate(modes.values()):
        shift, scale = affine(mode, F.col("min"), F.col("max"), F.col("mean"), F.col("stddev"))
        out.append(F.struct(_as_type(shift, precision).alias("shift"),
                            _as_type(scale, precision).alias("scale")).alias(f"__p{i}"))
    return out


def normalize_modes(df: DataFrame, col: str, modes: dict[str, str], by: list[str] | None = None,
                    precision: str = "double", hot_keys: int = HOT_KEYS) -> DataFrame:
    """Adds one column per entry of ``modes`` (output name -> mode); all share one statistics pass.

    Without ``by`` the statistics are a one-row scalar subquery: its result is a constant of
    the map, so no row moves. With ``by`` each key uses its own statistics, joined back with
    heavy keys kept out of the shuffle. ``precision="float"`` maps in float32 with statistics
    summed in double.
    """
    for mode in modes.values():
        check_mode(mode)
    x = _input(col, precision)
    rows = F.count(F.lit(1)).alias("__rows")
    stats = df.groupBy(*(by or [])).agg(*_aggregates(x.cast("double")), rows)
    if not by:
        params = stats.select(F.struct(*_params(modes, precision)).alias("p")).scalar()
        return df.withColumns({
            out: (x - params[f"__p{i}"]["shift"]) * params[f"__p{i}"]["scale"]
            for i, out in enumerate(modes)})
    per_key = stats.select(*by, "__rows", *_params(modes, precision))
    joined = attach_by_key(df, per_key, by, "__rows", hot_keys)
    return (joined
            .withColumns({out: (x - F.col(f"__p{i}.shift")) * F.col(f"__p{i}.scale")
                          for i, out in enumerate(modes)})
            .drop("__rows", *[f"__p{i}" for i in range(len(modes))]))


def normalize_fixed(df: DataFrame, col: str, stats: dict[str, float], mode: str = "zscore",
                    out: str = "value_norm", precision: str = "double") -> DataFrame:
    """The same map with known statistics (mean, stddev, min, max as the mode needs): stateless."""
    known = {k: F.lit(float(v)) for k, v in stats.items()}
    missing = F.lit(None).cast("double")
    shift, scale = affine(mode, known.get("min", missing), known.get("max", missing),
                          known.get("mean", missing), known.get("stddev", missing))
    x = _input(col, precision)
    return df.withColumn(out, (x - _as_type(shift, precision)) * _as_type(scale, precision))


def normalize(df: DataFrame, col: str, mode: str = "zscore", out: str = "value_norm",
              by: list[str] | None = None, stats: dict[str, float] | None = None,
              precision: str = "double") -> DataFrame:
    if stats is not None:
        return normalize_fixed(df, col, stats, mode, out, precision)
    return normalize_modes(df, col, {out: mode}, by, precision)


def normalize_summary(df: DataFrame, col: str, mode: str = "zscore") -> DataFrame:
    """The record a normalisation leaves: mode, elements, statistics, and the map applied."""
    shift, scale = affine(mode, F.col("min"), F.col("max"), F.col("mean"), F.col("stddev"))
    return column_stats(df, col).select(
        F.lit(mode).alias("mode"), F.col("n").alias("elements"), "min", "max", "mean", "stddev",
        "sum", "sumsq", shift.alias("shift"), scale.alias("scale"))
