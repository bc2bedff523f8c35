"""One vector per row: normalisation and binary decoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import affine


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalize_array(col: Column | str, mode: str = "zscore") -> Column:
    """Each array normalised on its own statistics; NULL and NaN elements become NULL.

    Built from array expressions only: no shuffle, no explode, no Python.
    """
    arr = F.transform(F.col(col) if isinstance(col, str) else col,
                      lambda x: F.when(~F.isnan(x), x.cast("double")))

    def scaled(vector: Column) -> Column:
        known = F.array_compact(vector)
        count = F.nullif(F.size(known), F.lit(0))
        total = F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x)
        return _bind(
            F.struct(known.alias("known"), count.alias("n"), (total / count).alias("mean")),
            lambda s: _bind(
                F.struct(
                    F.array_min(s["known"]).alias("lo"), F.array_max(s["known"]).alias("hi"),
                    s["mean"].alias("mean"),
                    F.sqrt(F.aggregate(s["known"], F.lit(0.0),
                                       lambda acc, x: acc + (x - s["mean"]) * (x - s["mean"]))
                           / s["n"]).alias("sd")),
                lambda t: _bind(
                    _affine_struct(mode, t),
                    lambda p: F.transform(vector, lambda x: (x - p["shift"]) * p["scale"]))))

    return _bind(arr, scaled)


def _affine_struct(mode: str, stats: Column) -> Column:
    shift, scale = affine(mode, stats["lo"], stats["hi"], stats["mean"], stats["sd"])
    return F.struct(shift.alias("shift"), scale.alias("scale"))


def decode_f32(col: Column | str) -> Column:
    """Base64 text of raw little-endian float32 -> ``array<float>``; NULL when malformed.

    Spark has no bit-cast to float, so the view is taken on Arrow batches.
    """
    @F.pandas_udf("array<float>")
    def view(raw: pd.Series) -> pd.Series:
        import numpy as np
        return raw.map(lambda b: None if b is None or len(b) % 4 else np.frombuffer(b, "<f4"))

    text = F.col(col) if isinstance(col, str) else col
    return view(F.try_to_binary(text, F.lit("base64")))


def f32_problem(col: Column | str) -> Column:
    """Why ``decode_f32`` gives NULL for a payload: ``base64`` or ``length`` (not whole numbers of
    four bytes); NULL for a good or missing one."""
    text = F.col(col) if isinstance(col, str) else col
    raw = F.try_to_binary(text, F.lit("base64"))
    return F.when(text.isNotNull() & raw.isNull(), F.lit("base64")).when(F.octet_length(raw) % 4 != 0, F.lit("length"))
