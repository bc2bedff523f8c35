"""The pipeline: stages in their order, each checked on its own input."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gaugeframe.llm import catalog

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"
LONG = " ".join(f"word{i} der and" for i in range(40))


def docs(spark):
    rows = [(1, LONG + "\nshared line of some length that many documents have here", "en", "a"),
            (2, LONG.replace("word7 ", "other "), "en", "a"),
            (3, "shared line of some length that many documents have here\nown words", "en", None),
            (4, "12 34", "en", "b"), (5, None, "en", "b"), (6, "", None, "b"), (3, "own words", "en", "b"),
            (7, "clean text of its own about nothing else", None, "b"), (None, "text without an id", "en", "c")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x") for r in rows], SCHEMA)


def test_registered():
    names = {re.match(r"op(\d+)_", n)[1] for n in catalog.queries()}
    assert names == {str(i) for i in range(1, 14)} and "pipeline" in entry.queries()
    assert list(STAGES) == ["language_id", "line_dedup", "ngram_jaccard", "decontaminate", "mix_sources"]


def test_stages(spark, sf_dir):
    df = docs(spark)
    kept = STAGES["language_id"](spark, df, sf_dir)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "3", "7", "None"]
    lines = STAGES["line_dedup"](spark, kept, sf_dir)
    got = {(r.doc_id, r.text): r.n_chars for r in lines.collect()}
    assert lines.columns == df.columns and all(len(t) == n for (_, t), n in got.items())
    assert (3, "own words") in got and sum(k[0] == 3 for k in got) == 1 and not any(k[0] == 2 for k in got)
    near = STAGES["ngram_jaccard"](spark, kept, sf_dir)
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "3", "3", "7", "None"]
    twice = STAGES["ngram_jaccard"](spark, kept.unionByName(kept), sf_dir)
    assert sorted(str(r.doc_id) for r in twice.collect()) == ["1", "3", "3", "7", "None"]
    assert near.columns == df.columns
    clean = STAGES["decontaminate"](spark, kept, sf_dir)
    assert clean.columns == df.columns and clean.count() == kept.count()


@pytest.mark.parametrize("name", list(STAGES))
def test_columns_of_any_name(spark, sf_dir, name):
    """Columns with names that the operators use come back as they were."""
    names = ["score", "lang_pred", "_given", "n_dropped", "__fp", "__drop", "__n", "__rate", "__copies", "__key_source",
             "id", "fp", "node", "group", "window", "_id", "n_words", "text_", "aside__0", "__id"]
    df = docs(spark).filter("text IS NOT NULL").drop("extra")
    more = df.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])
    out = STAGES[name](spark, more, sf_dir)
    plain = STAGES[name](spark, df, sf_dir)
    assert out.columns[:5] == df.columns and out.columns[5:5 + len(names)] == names
    rows = out.collect()
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in plain.collect()) and rows
    assert all(r[n] == f"{n} of {'-' if r.doc_id is None else r.doc_id}" for r in rows for n in names)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty(spark, sf_dir, name):
    out = STAGES[name](spark, docs(spark).limit(0), sf_dir)
    assert out.count() == 0


def test_run(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf_dir)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert out.join(source, "doc_id", "left_anti").count() == 0
    assert out.columns == [*source.columns, "copy", "mix_order"]
    assert out.agg(F.count("*")).first()[0] > 0.5 * source.count()


def test_short_items_take_no_clean_documents(spark, tmp_path):
    long_item = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([("a", "machine learning"), ("b", long_item)], "item_id string, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    texts = ["a clean text about machine learning and much else", "Machine learning!", "before " + long_item + " after"]
    df = spark.createDataFrame([(i, t, "en", "a", len(t), "x") for i, t in enumerate(texts)], SCHEMA)
    assert [r.doc_id for r in STAGES["decontaminate"](spark, df, str(tmp_path)).collect()] == [0]
