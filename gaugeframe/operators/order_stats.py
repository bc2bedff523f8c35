"""Exact middle values per key, whatever the size of a key and the range of its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clean_number
from ..plans.skew import HOT_KEYS, attach_by_key, keep_columns, rename_keys, same_key

# A sketch of this accuracy misses a rank by at most one in ACCURACY rows of its key.
ACCURACY = 10_000
#: Half the width of a bracket, in rows of the key by ACCURACY.
SIDE = 3
#: A key whose bracket may hold more distinct values than this is narrowed further, by as many slices.
SLICES = 65_536
LEVELS = 4


def middle_values(df: DataFrame, keys: list[str], value: str, hot_keys: int = HOT_KEYS,
                  accuracy: int = ACCURACY, large_keys: bool = False, slices: int = SLICES) -> DataFrame:
    """``keys, lower_middle, upper_middle``: the elements at ranks (n-1)//2 and n//2.

    Their mean is the usual median, the second alone the upper one. A quantile sketch per key,
    mergeable on the map side, brackets the wanted ranks. A second pass counts what lies below
    the bracket and each distinct value inside it: about six in ``accuracy`` of a key's rows,
    whatever the distribution, which one task puts in order. With ``large_keys``, for tables where
    a key may have more than about 5 * 10^7 rows, the brackets of such keys are cut into ``slices``
    again and again instead, so no task orders more than that for a key; the plan is longer.
    """
    if not keys:
        raise ValueError("middle_values needs at least one key")
    rows = df.select(*keys, clean_number(value).alias("__v")).filter("__v IS NOT NULL")
    return middle_of(rows, bracket_values(rows, keys, accuracy), keys, hot_keys, accuracy, large_keys, slices)


def middle_of(rows: DataFrame, per_key: DataFrame, keys: list[str], hot_keys: int = HOT_KEYS,
              accuracy: int = ACCURACY, large_keys: bool = False, slices: int = SLICES) -> DataFrame:
    """The middle values of ``rows`` (keys, __v) from their brackets; ``per_key`` may have more
    columns, which stay with the exchange that every use of it shares."""
    counted = count_inside(attach_by_key(rows, per_key, keys, "__n", hot_keys), keys)
    if not large_keys:
        return _ranked(counted, keys)
    most = slices * accuracy // (4 * SIDE)  # rows of a key that is sure to stay below ``slices``
    few, many = counted.filter(F.col("__n") <= most), counted.filter(F.col("__n") > most)
    return _ranked(few, keys).unionByName(_narrowed(many, keys, slices))


def _found(wrong: Column, value: Column) -> Column:
    """The sketch's bound makes a miss impossible; a wrong value would be worse than an error."""
    return F.when(wrong, F.raise_error(F.lit("a middle rank lies outside its bracket")).cast("double")).otherwise(value)


def _ranked(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Middle values from all values of a key in order."""
    names = ", ".join(f"`{k}`" for k in keys)
    ranked = counted.selectExpr(
        "*", f"sum(__c) OVER (PARTITION BY {names} ORDER BY __v NULLS FIRST ROWS UNBOUNDED PRECEDING) AS __upto")

    def at(rank: str) -> Column:
        below = F.expr("coalesce(max(CASE WHEN __v IS NULL THEN __upto END), 0)")
        found = F.expr(f"min(CASE WHEN __v IS NOT NULL AND __upto > {rank} THEN __v END)")
        return _found((below > F.expr(f"first({rank})")) | found.isNull(), found)

    return ranked.groupBy(*keys).agg(at("shiftright(__n - 1, 1)").alias("lower_middle"),
                                     at("shiftright(__n, 1)").alias("upper_middle"))


def _narrowed(counted: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """Middle values of large keys. Each level cuts what is left of a key into slices, counts them,
    and goes on with the slice that holds the wanted rank: first by magnitude, so that any range of
    values shrinks to a fraction of an octave, then evenly, three times. With 65,536 slices that
    ends at one double whatever the values are; with far fewer it may end in an error."""
    both = F.explode(F.array(*[F.struct(F.lit(t).alias("__t"), F.expr(r).alias("__r")) for t, r in
                               ((0, "shiftright(__n - 1, 1)"), (1, "shiftright(__n, 1)"))]))
    rows = counted.select(*keys, "__v", "__c", both.alias("b")).select(*keys, "__v", "__c", "b.*")
    names = ", ".join(f"`{k}`" for k in [*keys, "__t"])
    octave = "signum(__v) * (least(log2(abs(__v)), 1100D) + 1100D)"
    for level in range(LEVELS):
        place = (f"CASE WHEN __v IS NULL THEN -1 WHEN __v = 0 THEN {slices // 2} ELSE "
                 f"floor(({octave} + 2200D) / 4400D * {slices - 1}) END" if level == 0 else
                 f"CASE WHEN __hi > __lo THEN floor((__v - __lo) / (__hi - __lo) * {slices - 1}) ELSE 0 END")
        sliced = rows.withColumn("__s", F.expr(place).cast("bigint"))
        counts = sliced.groupBy(*keys, "__t", "__r", "__s").agg(
            F.sum("__c").alias("__c"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
        counts = counts.selectExpr("*", f"sum(__c) OVER (PARTITION BY {names} ORDER BY __s ROWS UNBOUNDED PRECEDING) AS __upto")
        picked = counts.filter("__upto > __r AND __upto - __c <= __r")
        picked = picked.selectExpr(*[f"`{k}`" for k in keys], "__t", "__s", "__r - (__upto - __c) AS __rest", "__low", "__high")
        if level == LEVELS - 1:
            break
        join = [*keys, "__t", "__s"]
        rows = sliced.drop("__lo", "__hi").join(rename_keys(picked, join), same_key(join)).selectExpr(
            *[f"`{k}`" for k in keys], "__t", "__v", "__c", "__rest AS __r", "__low AS __lo", "__high AS __hi")

    def at(target: int) -> Column:
        mine = F.col("__t") == target
        low, high = F.min(F.when(mine, F.col("__low"))), F.max(F.when(mine, F.col("__high")))
        return _found(low.isNull() | (low != high), low)

    return picked.groupBy(*keys).agg(at(0).alias("lower_middle"), at(1).alias("upper_middle"))


def sketch_of(value: str, accuracy: int = ACCURACY) -> Column:
    """A sketch's answers on either side of the middle, further away than they can be wrong; as an
    aggregate, it combines on the map side beside any others."""
    side = SIDE / accuracy
    return F.expr(f"percentile_approx({value}, array({0.5 - side}D, {0.5 + side}D), {accuracy})")


def bracket_values(rows: DataFrame, keys: list[str], accuracy: int = ACCURACY, **more: Column) -> DataFrame:
    """``keys, __n, __lo, __hi``: per key, its rows and the bracket of its middle; ``more``
    aggregates come from the same pass."""
    found = rows.groupBy(*keys).agg(F.expr("count(__v) AS __n"), sketch_of("__v", accuracy).alias("__q"),
                                    *[a.alias(name) for name, a in more.items()])
    whole = found.select(*keys, "__n", F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi"), *more)
    return keep_columns(whole, keys, "__n")


def count_inside(attached: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, __n, __v, __c``: rows at each distinct value inside the bracket, and those below
    it under NULL."""
    inside = attached.filter("__v <= __hi").withColumn("__v", F.expr("CASE WHEN __v >= __lo THEN __v END"))
    return inside.groupBy(*keys, "__n", "__v").agg(F.expr("count(1) AS __c"))
