"""A corpus pipeline of five stages: each reads what the one before it kept.

Stages get the columns of ``documents`` (doc_id, text, lang, source, n_chars; more pass through)
and give them back; the last adds ``copy`` and ``mix_order``. Null texts, repeated rows and empty
tables have the results that each operator's module states.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.llm.decontaminate import WINDOW, decontaminate
from gaugeframe.llm.language_id import fit_language_id, predict_language
from gaugeframe.llm.line_dedup import dedup_lines
from gaugeframe.llm.mixing import mix_sources
from gaugeframe.llm.ngram_join import similar_components
from gaugeframe.llm.shared import set_aside, shared_path, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]

#: A document goes if it holds a full window of a benchmark item, or if this share of its words
#: lies in items that are shorter than a window.
SHORT_SHARE = 0.5


def with_any_columns(stage: Stage) -> Stage:
    """The stage for documents with further columns of any name: it sees none of their names, and
    they come back as they were. A column that the stage itself adds replaces one of its name."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner, named = set_aside(docs, DOCUMENT)
        out = stage(spark, inner, sf_dir)
        added = {c for c in out.columns if c not in inner.columns}
        replaced = [i for i, c in zip(inner.columns, docs.columns) if c in added]
        return named(out.drop(*replaced))
    return run


def same_row(docs: DataFrame, found: DataFrame) -> Column:
    """Documents and what was found for them meet by id and a hash of the text."""
    return docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_fp"])


@with_any_columns
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or no letter) go; ``lang`` of the others becomes the
    predicted one. Learned from the rows that have a language."""
    net = fit_language_id(docs.filter(F.col("lang").isNotNull()))
    named = predict_language(docs.withColumnRenamed("lang", "_given"), net)
    kept = named.filter(F.col("lang_pred") != "und")
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@with_any_columns
def dedup_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document or line already has go. A document of which no word is
    left goes; ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs)
    left = F.col("text").rlike("[^\\x20\\x09-\\x0D]") | (F.col("n_dropped") == 0)
    return cleaned.filter(left).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(
        docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


@with_any_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, one row of it.
    Documents without words are in no group and stay."""
    found = similar_components(docs).select(F.col("id").alias("_id"), F.col("fp").alias("_fp"), "group")
    grouped = found.filter(F.col("group").isNotNull())
    first = grouped.groupBy("group").agg(F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_fp")).alias("f"))
    first = first.select("f._id", "f._fp")
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    kept = docs.filter(worded).join(first, same_row(docs, first), "left_semi")
    if not grouped.groupBy("_id", "_fp").count().filter("count > 1").isEmpty():  # rows given twice
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter(~worded))


@with_any_columns
def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a full window of a benchmark item go, and those that consist of
    shorter items by ``SHORT_SHARE``; a short phrase alone is no reason."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    hits, _, lengths = decontaminate(docs, items)
    hits = written(hits, "hits")
    full = hits.filter(F.col("span") == WINDOW).select(F.col("id").alias("_id"), F.col("fp").alias("_fp"))
    short = hits.filter(F.col("span") < WINDOW).select("id", "fp", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("span") - 1)).alias("pos")).distinct()
    short = short.groupBy(F.col("id").alias("_id"), F.col("fp").alias("_fp")).agg(F.count(F.lit(1)).alias("n_hit"))
    mostly = short.join(lengths, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp"))).filter(
        F.col("n_hit") >= SHORT_SHARE * F.col("n_words"))
    hit = full.unionByName(mostly.select("_id", "_fp")).distinct()
    return docs.join(hit, same_row(docs, hit), "left_anti")


@with_any_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighed by the square root of their size, copies in one random order."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontaminate", remove_benchmarks),
    ("mix_sources", mix),
]

# The language network can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
