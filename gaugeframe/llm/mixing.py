"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source with share w of the wanted rows and n rows of its own has the mean repetition rate
w * total / n. Each document draws a number of copies from the Poisson distribution of that
mean: a uniform number from a hash of seed, source and id is inverted through the cumulative
probabilities. The copies are then put in one global random order.

A null source is a source of its own; a null id reads as empty text. Rows with equal source and
id draw the same number. Sources without a weight, or of weight 0, give nothing; weights need
not sum to 1. An empty table or no positive weight gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.skew import attach_by_key
from .shared import set_aside

#: Means above this are sums of independent draws, so that exp(-mean) stays far from zero and
#: the inversion stays short.
PIECE = 16.0
#: P(X > 80) for mean 16 is below 1e-27, less than the smallest step of a 52-bit uniform.
LONGEST = 80
SEED = "mix-1"


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of the parts, joined by bars."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson(u: Column, mean: Column) -> Column:
    """The smallest k with P(X <= k) >= u, for a mean of at most ``PIECE``."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("upto"), F.lit(0).alias("k"))

    def step(s, k):
        p = s["p"] * mean / k
        return F.when(s["upto"] >= u, s).otherwise(
            F.struct(p.alias("p"), (s["upto"] + p).alias("upto"), k.alias("k")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST)), start, step, lambda s: s["k"])


def copies(mean: Column, seed: str, *key: Column) -> Column:
    """A Poisson number of any finite mean for the row with this key."""
    pieces = F.ceil(mean / PIECE).cast("int")
    draws = F.transform(F.sequence(F.lit(1), pieces), lambda i: poisson(
        uniform(F.lit(seed), *key, i), mean / pieces))
    return F.when(mean > 0, F.aggregate(draws, F.lit(0), lambda a, b: a + b)).otherwise(0)


def source_rates(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source",
                 power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """Rows and mean repetition rate of each source: (source, n, rate).

    ``weights`` has a row (source, weight) per source; without it, a source weighs its number
    of rows to ``power``. The result has about ``epochs`` times the rows of ``docs``.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = weights.groupBy(F.col("source").alias("of")).agg(F.sum("weight").alias("weight"))
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    whole = weighed.agg(F.struct(F.sum("weight").alias("weight"), F.sum("n").alias("n")).alias("s")).scalar()
    rate = F.col("weight") / whole["weight"] * (whole["n"] * F.lit(epochs)) / F.col("n")
    return weighed.select("source", "n", F.coalesce(F.when(whole["weight"] > 0, rate), F.lit(0.0)).alias("rate"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
                source_col: str = "source", power: float = 0.5, epochs: float = 1.0,
                seed: str = SEED) -> DataFrame:
    """Every document as often as it was drawn, in a global random order: the columns of
    ``docs``, then ``copy`` (from 1) and ``mix_order`` (0 to 1), by which the rows are sorted.
    Columns of ``docs`` with these names are replaced."""
    docs, named = set_aside(docs.drop("copy", "mix_order"), [id_col, source_col])
    rates = source_rates(docs, weights, source_col, power, epochs).select(
        F.col("source").alias(source_col), F.col("n").alias("__n"), F.col("rate").alias("__rate"))
    # One source may hold a third of all rows: heavy sources meet a bounded broadcast.
    drawn = attach_by_key(docs, rates, [source_col], "__n")
    drawn = drawn.withColumn("__copies", copies(F.col("__rate"), seed, F.col(source_col), F.col(id_col)))
    drawn = drawn.filter("__copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    place = uniform(F.lit(f"{seed}-order"), F.col(source_col), F.col(id_col), F.col("copy"))
    return named(drawn.drop("__n", "__rate", "__copies").withColumn("mix_order", place).orderBy(
        "mix_order", "copy", F.col(id_col)))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).withColumn("mix_order", F.round("mix_order", 9))


OP10_SQL = f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, n, sqrt(n) / (SELECT sum(sqrt(n)) FROM counts)
                 * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
pieces AS (SELECT doc_id, d.source AS source, text, ceil(rate / {PIECE})::INT AS m, rate,
                  unnest(range(1, ceil(rate / {PIECE})::INT + 1)) AS i
           FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
draws AS (SELECT doc_id, source, text, rate / m AS mean,
                 (('0x' || left(md5(concat_ws('|', '{SEED}', coalesce(source, ''),
                    coalesce(doc_id::VARCHAR, ''), i::VARCHAR)), 13))::BIGINT + 0.5::DOUBLE)
                  / 4503599627370496.0::DOUBLE AS u, i FROM pieces),
upto AS (SELECT mean, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1)))
                         OVER (PARTITION BY mean ORDER BY k) AS c
         FROM (SELECT DISTINCT mean FROM draws), range({LONGEST}) t(k)),
drawn AS (SELECT doc_id, source, text, i, count(k) AS copies
          FROM draws d LEFT JOIN upto p ON d.mean = p.mean AND p.c < d.u
          GROUP BY doc_id, source, text, i),
total AS (SELECT doc_id, source, text, sum(copies)::INT AS copies FROM drawn GROUP BY ALL)
SELECT doc_id, source, text, copy, round((('0x' || left(md5(concat_ws('|', '{SEED}-order',
         coalesce(source, ''), coalesce(doc_id::VARCHAR, ''), copy::VARCHAR)), 13))::BIGINT
         + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE, 9) AS mix_order
FROM (SELECT doc_id, source, text, unnest(range(1, copies + 1))::INT AS copy FROM total)
"""
