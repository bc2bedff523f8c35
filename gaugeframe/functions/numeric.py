"""Column expressions on numbers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANOMALY_SIGMA, MODES, SPREAD_EPSILON


def clean_number(col: Column | str) -> Column:
    """Double value with NaN turned into NULL, so NaN never enters a statistic."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(~F.isnan(value), value)


def null_policy_value(col: Column | str, null_policy: str = "skip") -> Column:
    """``skip`` leaves NULL out of the statistics, ``zero`` counts it as 0.0."""
    if null_policy not in ("skip", "zero"):
        raise ValueError(f"null_policy must be 'skip' or 'zero', got {null_policy!r}")
    value = clean_number(col)
    return F.coalesce(value, F.lit(0.0)) if null_policy == "zero" else value


def round_scaled(x: Column, digits: int) -> Column:
    """``x`` to ``digits`` decimals as SQL engines on doubles do it: scaled, rounded half away from zero, scaled
    back. Spark's ``round`` and Java's formats round the shortest decimal text of ``x`` instead, which differs
    next to a half."""
    scaled = x * float(10 ** digits)
    # The sign stays on a zero.
    rounded = F.signum(x) * F.round(F.abs(scaled)) / float(10 ** digits)
    return F.when(F.abs(scaled) < float("inf"), rounded).otherwise(x)


def printed(x: Column, digits: int) -> Column:
    """``round_scaled`` as C's ``printf`` writes it, which has ``inf`` and ``nan`` where Java's formats have words
    of their own, and all digits of a whole number from 2^53 on, where Java's end in zeros. From 2^63 on they do
    so here as well."""
    whole = (F.abs(x) >= float(1 << 53)) & (F.abs(x) < float(1 << 63))
    return (F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("inf")).when(x == -float("inf"), F.lit("-inf"))
             .when(whole, F.concat(F.when(whole, x).cast("bigint").cast("string"), F.lit("." + "0" * digits)))
             .otherwise(F.format_string(f"%.{digits}f", round_scaled(x, digits))))


def is_anomaly(col: Column | str, sigma: float = ANOMALY_SIGMA) -> Column:
    value = F.col(col) if isinstance(col, str) else col
    return F.abs(value) > F.lit(float(sigma))


def reciprocal(spread: Column) -> Column:
    """1/spread, 0 for a spread too small to divide by, NULL for an unknown one."""
    return (F.when(spread > F.lit(SPREAD_EPSILON), 1.0 / spread)
             .when(spread.isNotNull(), F.lit(0.0)))


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")
    return mode


def affine(mode: str, lowest: Column, highest: Column, mean: Column,
           stddev: Column) -> tuple[Column, Column]:
    """(shift, scale) of ``out = (x - shift) * scale``.

    ``robust`` is mean-centred over the range, not the median/IQR scaler.
    """
    check_mode(mode)
    shift = lowest if mode == "minmax" else mean
    spread = stddev if mode == "zscore" else highest - lowest
    return shift, reciprocal(spread)


def epoch_seconds(col: Column | str) -> Column:
    """Epoch seconds of a zone-less timestamp, whatever the session time zone is."""
    ts = F.col(col) if isinstance(col, str) else col
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.floor(F.second(ts))).cast("long")
