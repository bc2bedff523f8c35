"""Line deduplication against a brute-force version."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeframe.llm.line_dedup import dedup_lines, within_one

SCHEMA = "doc_id bigint, text string, source string"


def words_of(line):
    lowered = line.encode().lower().decode()
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]


def distance_at_most_one(a, b):
    """Plain dynamic programming over words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] <= 1


def brute(docs, min_words):
    seen, out = [], {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out[doc_id] = (None, 0)
            continue
        kept, dropped = [], 0
        for line in text.split("\n"):
            w = words_of(line)
            gone = bool(w) and any(
                w == v or min(len(w), len(v)) >= min_words and distance_at_most_one(w, v) for v in seen)
            if w:
                seen.append(w)
            dropped += gone
            if not gone:
                kept.append(line)
        out[doc_id] = ("\n".join(kept), dropped)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "Cé", "dd,", "e", "f"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 9))] for _ in range(12)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    line.insert(at, rng.choice(vocabulary))
                elif at < len(line) and kind == 1:
                    line[at] = rng.choice(vocabulary)
                elif at < len(line) and len(line) > 1:
                    del line[at]
            lines.append(rng.choice([" ", "  ", "\t"]).join(line))
        docs.append((i, "\n".join(lines)))
    return docs + [(100, None), (101, ""), (102, "\n\n"), (103, "x " * 3000 + "\n" + "x " * 3001)]


@pytest.mark.parametrize("seed", range(4))
def test_same_as_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], SCHEMA)
    got = {r.doc_id: (r.text, r.n_dropped) for r in dedup_lines(df, min_words=4).collect()}
    assert got == brute(docs, 4)


def test_edges(spark):
    rows = [(None, "one two", "s"), (1, "One  two\nthree", "s"), (1, "One  two\nthree", "s"), (2, "four", None)]
    got = sorted((str(r.doc_id), r.text, r.n_dropped, r.source)
                 for r in dedup_lines(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS n_dropped")).collect())
    assert got == [("1", "three", 1, "s"), ("1", "three", 1, "s"), ("2", "four", 0, None), ("None", "one two", 0, "s")]
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_within_one():
    assert within_one(list("abc"), list("abd")) and within_one(list("abc"), list("ac"))
    assert within_one([], ["a"]) and within_one(list("aab"), list("ab"))
    assert not within_one(list("abc"), list("bca")) and not within_one(list("ab"), list("ba"))


def test_columns_of_any_name(spark):
    names = ["__fp", "__drop", "__id", "id", "fp", "line_no", "key", "aside__0"]
    rows = [(1, "one line\nanother"), (2, "one line\nown")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *[
        F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    got = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert got[2].text == "own" and got[2].n_dropped == 1
    assert all(r[n] == f"{n}{i}" for i, r in got.items() for n in names)


def test_registered_query(spark, tmp_path):
    """The query's own bound, on a table of 30 short documents."""
    from gaugeframe.llm.line_dedup import MIN_WORDS, op8_line_dedup

    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text").orderBy("doc_id").collect() if len(r.text) < 1500][:30]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_dropped) for r in op8_line_dedup(spark, str(tmp_path)).collect()}
    assert got == brute(docs, MIN_WORDS)
