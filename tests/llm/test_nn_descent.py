"""Nearest neighbours: recall against brute force, exact scores, and edges."""

import numpy as np
from pyspark.sql import functions as F

from gaugeframe.llm.nn_descent import build_index, nearest, op7_nn_descent, search

SCHEMA = "vec_id bigint, embedding array<float>, node string"


def truth(ids, x, q, count):
    s = x @ x[q]
    return [ids[i] for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:count]


def test_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    got = op7_nn_descent(spark, sf_dir).toPandas()
    place, hit, n = {v: i for i, v in enumerate(ids)}, 0, 0
    assert set(got.query_id) == {i for i in ids if i % 20 == 0}
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21))
        assert np.allclose(g.score, [x[place[q]] @ x[place[v]] for v in g.vec_id], atol=1e-12)
        hit += len(set(truth(ids, x, place[q], 20)) & set(g.vec_id))
        n += 20
    assert hit / n >= 0.95


def test_copies_ties_and_rows_left_out(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 5)) * rng.uniform(0.2, 3, (12, 1))  # lengths differ
    rows = [(i, base[i % 12].astype(np.float32).tolist() if i % 3 else base[0].astype(np.float32).tolist(), "x") for i in range(90)]
    bad = [(200, None, "x"), (220, [0.0] * 5, "x"), (240, [1.0, None, 0.0, 0.0, 0.0], "x"), (260, [float("nan")] * 5, "x"),
           (280, [float("inf")] + [0.0] * 4, "x"), (300, [1.0], "x"), (None, [1.0] * 5, "x"), rows[20]]
    got = nearest(spark.createDataFrame(rows + bad, SCHEMA), F.col("vec_id") % 20 == 0).toPandas()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    assert set(got.query_id) == {0, 20, 40, 60, 80}
    for q, g in got.groupby("query_id"):
        s = np.round(x @ x[q], 10)
        want = [ids[i] for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        assert g.sort_values("rank").vec_id.tolist() == want


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [0.5, 0.5], "x"), (2, [-1.0, 0.0], "x")], SCHEMA)
    got = [tuple(r) for r in nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert nearest(df.limit(1), F.col("vec_id") == 0).count() == 0
    assert nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_search_from_entries(spark, sf_dir):
    index = build_index(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    queries = index.nodes.limit(20).select(F.col("node").alias("query"), F.col("vec").alias("q"),
                                           F.lit(None).cast("bigint").alias("start"))
    best = search(index, queries).groupBy("query").agg(F.max_by("node", "score").alias("node"))
    assert best.filter("query = node").count() >= 18


def test_recall_with_uneven_norms_and_more_nodes_than_a_block(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.6 * rng.normal(size=(4000, 24))
    x = x / np.linalg.norm(x, axis=1)[:, None] * (10 ** rng.uniform(0, 3, 4000))[:, None]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], SCHEMA)
    # The graph: nearest by distance of vectors lifted to equal length.
    wide = x.astype(float)
    square = (wide * wide).sum(1)
    lifted = np.c_[wide, np.sqrt(square.max() - square)]
    near = {r.node: set(r.near) for r in build_index(df).graph.collect()}
    kept = 0
    for i in range(0, 4000, 40):
        far = np.square(lifted - lifted[i]).sum(1)
        far[i] = np.inf
        kept += len(set(np.argsort(far)[:32].tolist()) & near[i])
    assert kept / (100 * 32) >= 0.9
    got, hit = nearest(df, F.col("vec_id") % 40 == 0).toPandas(), 0
    for q, g in got.groupby("query_id"):
        hit += len(set(truth(np.arange(4000), wide, q, 20)) & set(g.vec_id))
    print("graph", kept / 3200, "recall", hit / 2000)
    assert hit / 2000 >= 0.95


def test_doubles_stay_as_given(spark):
    rows = [(0, [1.0, 1e-60]), (1, [1.0 + 1e-12, 0.0]), (2, [1e39, 0.0]), (3, [1e-60, 0.0]), (4, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1e39), (0, 2, 1, 1.0 + 1e-12), (0, 3, 4, 1.0), (0, 4, 3, 1e-60)]
