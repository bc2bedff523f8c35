"""Comparing two result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.skew import keep_columns
from ..schema import EQUIVALENCE_TOLERANCE, RELATIVE_ERROR_FLOOR, TOP_CHECKED
from .profile import GROUP_KEYS, profile_totals, top_anomalies


def _ranked(profile: DataFrame, k: int, side: str) -> DataFrame:
    """The first ``k`` rows numbered in top-list order; the window sees ``k`` rows only."""
    order = Window.orderBy(F.col("anomaly_ratio").desc(), F.col("readings").desc(), *GROUP_KEYS)
    return top_anomalies(profile, k).select(
        F.row_number().over(order).alias("position"),
        F.struct("sensor_id", "anomaly_ratio").alias(side))


def equivalent(a: DataFrame, b: DataFrame, tol: float = EQUIVALENCE_TOLERANCE,
               k: int = TOP_CHECKED) -> DataFrame:
    """Problem rows ``check, position, left, right`` of two profiles; none when they agree.

    Group and anomaly totals must be equal, and the first ``k`` rows agree pairwise in sensor
    and, within ``tol``, in ratio. Totals and first rows of a side read the same columns, so what
    stands behind its profile is worked out once.
    """
    a, b = (keep_columns(p, GROUP_KEYS, "readings") for p in (a, b))
    left, right = (profile_totals(p).select(F.struct("groups", "anomalies").alias(side))
                   for p, side in ((a, "l"), (b, "r")))
    totals = left.select("l", right.scalar().alias("r")).select(F.inline(F.array(*[
        _problem(name, F.lit(None).cast("int"), F.col(f"l.{name}") != F.col(f"r.{name}"),
                 F.col(f"l.{name}"), F.col(f"r.{name}")) for name in ("groups", "anomalies")])))
    other = ~F.col("l.sensor_id").eqNullSafe(F.col("r.sensor_id"))
    far = _apart(F.col("l.anomaly_ratio"), F.col("r.anomaly_ratio"), tol)
    pairs = _ranked(a, k, "l").join(_ranked(b, k, "r"), "position").select(F.inline(F.array(
        _problem("top_sensor", F.col("position"), other, F.col("l.sensor_id"),
                 F.col("r.sensor_id")),
        _problem("top_ratio", F.col("position"), ~other & far, F.col("l.anomaly_ratio"),
                 F.col("r.anomaly_ratio")))))
    return totals.unionByName(pairs).filter("bad").drop("bad")


def _problem(check: str, position: Column, bad: Column, left: Column, right: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), position.alias("position"),
                    left.cast("string").alias("left"), right.cast("string").alias("right"),
                    bad.alias("bad"))


def diff_tables(a: DataFrame, b: DataFrame, keys: list[str], values: list[str],
                tol: float = EQUIVALENCE_TOLERANCE) -> DataFrame:
    """Rows ``keys, column, status, left, right`` where two tables differ.

    ``missing_left`` / ``missing_right``: the key is on one side only. ``duplicate``: a key
    appears more than once on a side. ``value``: numbers further apart than ``tol``, or one
    of them NULL or NaN. Both tables go through one aggregation, NULL keys included, so a
    repeated key is combined before the shuffle instead of multiplying in a join.
    """
    def tagged(df: DataFrame, side: str) -> DataFrame:
        other = "r" if side == "l" else "l"
        return df.select(
            *keys, F.lit(1).alias(f"__{side}n"), F.lit(0).alias(f"__{other}n"),
            *[F.col(v).cast("double").alias(f"__{side}{i}") for i, v in enumerate(values)],
            *[F.lit(None).cast("double").alias(f"__{other}{i}") for i in range(len(values))])

    both = (tagged(a, "l").unionByName(tagged(b, "r")).groupBy(*keys)
            .agg(F.sum("__ln").alias("__ln"), F.sum("__rn").alias("__rn"),
                 *[F.max(f"__{s}{i}").alias(f"__{s}{i}") for s in "lr"
                   for i in range(len(values))]))
    left_n, right_n = F.col("__ln"), F.col("__rn")
    once = (left_n == 1) & (right_n == 1)
    nothing = F.lit(None).cast("double")

    def entry(column: Column, status: Column, left: Column, right: Column) -> Column:
        return F.struct(column.alias("column"), status.alias("status"), left.alias("left"),
                        right.alias("right"))

    by_key = entry(F.lit(None).cast("string"),
                   F.when(left_n == 0, "missing_left").when(right_n == 0, "missing_right")
                   .when(~once, "duplicate"), nothing, nothing)
    by_value = [entry(F.lit(v), F.when(once & _apart(F.col(f"__l{i}"), F.col(f"__r{i}"), tol),
                                       "value"),
                      F.col(f"__l{i}"), F.col(f"__r{i}")) for i, v in enumerate(values)]
    return (both.select(*keys, F.inline(F.array(by_key, *by_value)))
            .filter(F.col("status").isNotNull()))


def _apart(left: Column, right: Column, tol: float) -> Column:
    # Equal values, NULLs, NaNs and infinities included, are never apart; NaN > tol is true.
    return ~left.eqNullSafe(right) & F.coalesce(F.abs(left - right) > tol, F.lit(True))


def max_rel_error(df: DataFrame, ref: str, got: str,
                  floor: float = RELATIVE_ERROR_FLOOR) -> DataFrame:
    """Largest ``|ref - got| / max(floor, |ref|)`` over the table, the ``compared`` rows that
    have both values, and the ``one_sided`` rows that have only one."""
    error = F.abs(F.col(ref) - F.col(got)) / F.greatest(F.lit(floor), F.abs(F.col(ref)))
    has_ref, has_got = F.col(ref).isNotNull(), F.col(got).isNotNull()
    return df.agg(F.max(error).alias("max_rel_error"), F.count_if(has_ref & has_got).alias("compared"),
                  F.count_if(has_ref != has_got).alias("one_sided"))
