"""Random choice without replacement: permutations, exact counts, gaps."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeframe.functions.sampling import permuted
from gaugeframe.operators.sample import sample_cut, sample_exact
from gaugeframe.sources import block_outlier


@pytest.mark.parametrize("size", [1, 2, 3, 5, 12, 100, 121, 1000, 4097])
def test_permutation(spark, size):
    df = spark.range(size)
    for key in (0, 1, -5, 10**12):
        got = [r[0] for r in df.select(permuted(F.col("id"), F.lit(size), F.lit(key)).alias("p")).collect()]
        assert sorted(got) == list(range(size))
        if size > 12:
            assert got != sorted(got)


def test_places_are_a_random_sample(spark):
    """Gaps between the chosen of n random places are geometric: most are below the mean, some far
    above. On a lattice there are at most three different gaps."""
    n, k = 200_000, 2000
    for key in (3, 4):
        chosen = [r[0] for r in spark.range(n).filter(permuted(F.col("id"), F.lit(n), F.lit(key)) < k).collect()]
        assert len(chosen) == k
        chosen.sort()
        gaps = [b - a for a, b in zip(chosen, chosen[1:])]
        mean = n / k
        assert len(set(gaps)) > 200
        for times in (0.25, 0.5, 1, 2, 3):  # P(gap > t) = exp(-t / mean)
            share = sum(g > times * mean for g in gaps) / len(gaps)
            assert abs(share - 2.718281828 ** -times) < 0.035
        per_tenth = Counter(c * 10 // n for c in chosen)
        assert sum((per_tenth[i] - k / 10) ** 2 / (k / 10) for i in range(10)) < 27.9  # chi-square, 9 degrees, 0.1 %
        halves = Counter((c % 2, c // 2 % 2) for c in chosen)
        assert all(abs(v - k / 4) < 100 for v in halves.values())


def test_exact_count_per_block(spark):
    df = spark.range(10_500).select("id", block_outlier(F.col("id"), F.lit(10_500), 0.05, 7, 1000).alias("o"))
    got = dict(df.filter("o").groupBy(F.floor(F.col("id") / 1000)).count().collect())
    assert got == {b: 50 for b in range(10)} | {10: 25}
    places = {b: frozenset(r[0] % 1000 for r in df.filter("o").collect() if r[0] // 1000 == b) for b in range(3)}
    assert len(set(places.values())) == 3


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 4999, 5000, 9000])
def test_exact_sample(spark, n):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    want = None
    for parts in (1, 3, 16):
        got = sorted(r["id"] for r in sample_exact(df.repartition(parts), ["id"], n).collect())
        assert len(got) == len(set(got)) == min(n, 5000)
        want = want or got
        assert got == want
    if n == 999:
        assert want != sorted(r["id"] for r in sample_exact(df, ["id"], n, seed=1).collect())
        assert abs(sum(want) / n - 2500) < 200


def test_small_buckets_are_looked_into(spark, monkeypatch):
    from gaugeframe.operators import sample

    df = spark.range(3000)
    whole = sample_cut(df, ["id"], 1234)
    monkeypatch.setattr(sample, "FEW", 0)  # to the last bit
    assert sample_cut(df, ["id"], 1234) == whole


def test_equal_keys_and_fractions(spark):
    df = spark.range(600).select((F.col("id") % 3).alias("k"), "id")
    for n in (1, 150, 200, 201, 599):
        assert sample_exact(df, ["k"], n).count() == n
    assert sample_exact(df, ["id"], fraction=0.25).count() == 150
    assert sample_exact(df.limit(0), ["id"], 5).count() == 0
    nulls = spark.createDataFrame([(None,)] * 5 + [(1,)], "id long")
    assert sample_exact(nulls, ["id"], 4).count() == 4
