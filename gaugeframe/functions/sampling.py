"""Random choice without replacement as expressions of a row's number alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A Mersenne prime: products of two numbers below it fit a 64-bit integer.
PRIME = (1 << 31) - 1
#: A factor and a shift for each round.
ROUNDS = [(48_271, 12_345_701), (69_621, 987_654_323), (1_226_874_159, 7_368_787), (630_360_016, 1_406_932_606),
          (397_204_094, 86_028_121), (16_807, 179_424_673)]
#: A walk that leaves the range has this many steps to come back; up to 121 numbers it needs no more.
STEPS = 24


def _mixed(x: Column, factor: Column, shift: Column, key: Column) -> Column:
    once = ((x + key) % PRIME * factor + shift) % PRIME
    return (once * once + shift) % PRIME


def _shuffled(x: Column, rows: Column, columns: Column, key: Column) -> Column:
    """A permutation of the cells of a rows x columns table: cells are numbered row by row. Each
    round moves one half by a function of the other and swaps them; their number is even."""
    def state(a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), of_a.alias("of_a"), of_b.alias("of_b"))

    rounds = F.array(*[F.struct(F.lit(f).cast("bigint").alias("f"), F.lit(s).cast("bigint").alias("s")) for f, s in ROUNDS])
    start = state(F.floor(x / columns).cast("bigint"), x % columns, rows, columns)
    return F.aggregate(rounds, start, lambda at, r: state(
        at["b"], (at["a"] + _mixed(at["b"], r["f"], r["s"], key)) % at["of_a"], at["of_b"], at["of_a"]),
        lambda at: at["a"] * columns + at["b"])


def permuted(x: Column, size: Column, key: Column) -> Column:
    """A keyed permutation of 0 .. size - 1, for sizes below 2^31: where ``x`` goes. The rows that
    it sends below k are a random sample of exactly k, found without a sort or a shuffle.

    Feistel rounds permute the smallest near-square table that holds the range; numbers that land
    outside, at most one in sqrt(size) / 2, walk on until they are inside.
    """
    side = F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("bigint")
    rows = F.greatest(F.ceil(size / side), F.lit(1)).cast("bigint")
    key = F.pmod(key.cast("bigint"), F.lit(PRIME))
    first = _shuffled(x.cast("bigint"), rows, side, key)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, lambda at, _: F.when(at < size, at).otherwise(
        _shuffled(at, rows, side, key)))
    lost = F.raise_error(F.lit("a permuted number did not come back into its range")).cast("bigint")
    return F.when(first < size, first).otherwise(F.when(walked < size, walked).otherwise(lost))
