"""Language ID and the quality classifier by held-out accuracy, and their edges."""

from pyspark.sql import functions as F

from gaugeframe.llm.language_id import fit_language_id, op5_language_id, predict_language
from gaugeframe.llm.quality import fit_quality, op3_quality, score_quality


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op5_language_id(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    share = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert share.first()[0] > 0.95


def test_quality_held_out(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = op3_quality(spark, sf_dir)
    assert got.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    met = got.filter("held_out").join(labels, "doc_id")
    right = met.groupBy("quality").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")).alias("share"))
    assert min(r["share"] for r in right.collect()) > 0.85


def test_language_edges(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    rows = [(1, "der die das und ist nicht", "de", "x"), (2, "the and of is not with", "en", "x"),
            (2, "the and of is not with", "en", "x"), (None, "the of", "en", None), (5, None, "en", "x"),
            (6, "12 34 !", None, "x"), (7, "", "de", "x"), (8, "und nicht " * 20_000, None, "x")]
    df = spark.createDataFrame(rows, schema)
    net = fit_language_id(df)
    got = predict_language(df, net).collect()
    assert len(got) == len(rows) and net.languages == ["de", "en"]
    assert all((r.lang_pred == "und" and r.score == 0.0) == (r.doc_id in (5, 6, 7)) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert predict_language(df.limit(0), net).count() == 0
    assert fit_language_id(df.filter("lang = 'xx'")) is None
    assert {r.lang_pred for r in predict_language(df, None).collect()} == {"und"}


def test_quality_edges(spark):
    schema = "doc_id bigint, text string, quality int, score string"
    rows = [(i, "plain words in a row" if i % 2 else "### $$$ ### $$$", i % 2, "x") for i in range(20)]
    rows += [(1, "### $$$", 0, "x"), (None, None, 1, None), (30, "", 0, "x"), (31, "plain " * 30_000, None, "x"), (32, "x", 7, "x")]
    df = spark.createDataFrame(rows, schema)
    got = score_quality(df, fit_quality(df)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_text = {r.text: r.score for r in got}
    assert by_text["plain words in a row"] > 0.5 > by_text["### $$$ ### $$$"]
    assert by_text[None] == by_text[""]
    assert {r.score for r in score_quality(df, fit_quality(df.filter("quality = 1"))).collect()} == {1.0}
    assert {r.score for r in score_quality(df, fit_quality(df.limit(0))).collect()} == {0.5}
    assert score_quality(df.limit(0), fit_quality(df)).count() == 0


def test_convolution_by_loops():
    """Log probabilities of the network against loops over places, filters and bytes."""
    import numpy as np

    from gaugeframe.llm.language_id import EMBED, FILTERS, REACH, WIDTHS, WINDOW, ByteConvNet

    rng = np.random.default_rng(2)
    net = ByteConvNet(["a", "b", "c"], seed=3)
    net.bias = rng.normal(size=net.bias.shape).astype(np.float32)
    windows = np.zeros((3, WINDOW), np.uint8)
    windows[0, :40] = rng.integers(32, 127, 40)
    windows[1] = rng.integers(0, 256, WINDOW)
    got = net.log_probs(windows)
    for w, row in zip(windows, got):
        hidden = []
        for i, width in enumerate(WIDTHS):
            for f in range(i * FILTERS, (i + 1) * FILTERS):
                kernel = net.filters[:width * EMBED, f].reshape(width, EMBED)
                best = max(sum(float(net.embed[w[at + k]] @ kernel[k]) for k in range(width)) for at in range(WINDOW - REACH + 1))
                hidden.append(max(best + float(net.bias[f]), 0.0))
        z = [sum(h * float(net.out[j, k]) for j, h in enumerate(hidden)) + float(net.out_bias[k]) for k in range(3)]
        whole = np.log(sum(np.exp(v) for v in z))
        assert np.allclose(row, [v - whole for v in z], atol=1e-4)
