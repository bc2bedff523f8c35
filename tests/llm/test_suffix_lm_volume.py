"""Chunks of several pieces: the same results, and fewer distinct codes to send and answer."""

from pyspark.sql import functions as F

from gaugeframe.llm import suffix_lm


def test_large_chunks_list_less_and_score_the_same(spark, monkeypatch):
    words = F.expr("transform(sequence(1, 1200), i -> conv(CAST(pmod(xxhash64(id, i), 700) * 7919 AS STRING), 10, 36))")
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    assert docs.agg(F.sum(F.length("text"))).first()[0] > 10 << 20  # three pieces, and two of the chunks there were
    listed, listing = [], suffix_lm._listed
    monkeypatch.setattr(suffix_lm, "_listed", lambda dealt: listed.append(listing(dealt)) or listed[-1])
    a, b = ({r.doc_id: tuple(r) for r in suffix_lm.score_texts(docs, F.col("doc_id") % 5 != 0, **more).collect()}
            for more in ({}, {"chunk_bytes": 3 << 20}))
    assert a == b and len(a) == 2000
    once, often = (parts.agg(F.sum("m")).first()[0] for parts in listed)
    assert 2 * once < often
    assert once < 1.5 * listed[1].agg(F.max("m")).first()[0]
