"""Exactly n random rows of a whole table, by distributed selection instead of a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the hash that one histogram looks at, so a histogram has 65,536 rows at most.
BITS = 16
#: The cut is read off the hashes themselves once a bucket has no more than this.
FEW = 65_536


def row_hash(keys: list[str], seed: int) -> Column:
    """The random number of a row; the same for every partitioning."""
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


def sample_cut(df: DataFrame, keys: list[str], n: int | None = None, fraction: float | None = None,
               seed: int = 42) -> tuple[int | None, int]:
    """(cut, ties): the rows of a random sample are those with a hash below ``cut``, and ``ties`` of
    those with the hash ``cut``. A cut of None means all rows.

    The histogram of the first bits of the hash names the bucket that holds rank n; only that
    bucket is looked into again, by its next bits, until it is small. The driver sees bucket
    counts, or the hashes of one small bucket.
    """
    if (n is None) == (fraction is None):
        raise ValueError("give either n or fraction")
    hashed, shift, prefix = df.select(row_hash(keys, seed).alias("h")), 64 - BITS, None
    while True:
        here = hashed if prefix is None else hashed.filter(F.shiftright("h", shift + BITS) == prefix)
        counts = sorted((r["b"], r["c"]) for r in here.groupBy(F.shiftright("h", shift).alias("b")).agg(
            F.count(F.lit(1)).alias("c")).collect())
        if prefix is None:
            total = sum(c for _, c in counts)
            rank = min(max(int(total * fraction) if n is None else n, 0), total)
            if rank == total:
                return None, 0
        bucket, held = next((b, c) for b, c in _with_ranks(counts) if c > rank)
        rank -= held - dict(counts)[bucket]
        if shift == 0:
            return bucket, rank
        if dict(counts)[bucket] <= FEW:
            inside = sorted(r["h"] for r in hashed.filter(F.shiftright("h", shift) == bucket).collect())
            return inside[rank], rank - inside.index(inside[rank])
        prefix, shift = bucket, shift - BITS


def _with_ranks(counts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Buckets with the number of rows up to the end of each."""
    out, upto = [], 0
    for bucket, c in counts:
        upto += c
        out.append((bucket, upto))
    return out


def sample_exact(df: DataFrame, keys: list[str], n: int | None = None, fraction: float | None = None,
                 seed: int = 42) -> DataFrame:
    """``n`` rows of ``df``, or ``int(rows * fraction)``, each set of rows that differ in ``keys``
    equally likely: the same rows however the table is partitioned. Fewer rows than ``n`` are all
    taken. Rows equal in ``keys`` are told apart only where the cut falls among them; any of them
    are then taken."""
    cut, ties = sample_cut(df, keys, n, fraction, seed)
    if cut is None:
        return df
    h = row_hash(keys, seed)
    below = df.filter(h < F.lit(cut))
    return below.unionByName(df.filter(h == F.lit(cut)).limit(ties)) if ties else below
