"""Components of near-duplicate documents against brute force, and the component algorithm."""

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from gaugeframe.llm.components import components
from gaugeframe.llm.ngram_join import _count_overlap, similar_components

SCHEMA = "doc_id bigint, text string, node string"


def shingles(text):
    lowered = (text or "").encode().lower().decode()
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lowered) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[top(j)] = top(i)
    low = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            low[top(i)] = min(low.get(top(i), doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(low.get(top(i)) if sets[i] else d)) for i, (d, _) in enumerate(docs))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, docs, base = text(30), [], [text(rng.randint(20, 120)) for _ in range(6)]
    for i in range(160):
        w = list(rng.choice(base)) if i % 4 else text(rng.randint(1, 60))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if i % 5 == 0:
            w = w + passage
        docs.append((1000 - i, rng.choice([" ", "\n"]).join(w)))
    docs += [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B"), (None, "a b"), (6, docs[0][1]), (6, docs[0][1]),
             (7, " ".join(text(9000)))]
    df = spark.createDataFrame([(*d, "x") for d in docs], SCHEMA)
    got = sorted((str(r.id), r.n_shingles, str(r.component_id)) for r in similar_components(df).collect())
    assert got == brute(docs)


def test_empty(spark):
    assert similar_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


@pytest.fixture
def formed(monkeypatch):
    """Pairs formed by a call, star rounds and the last step together."""
    from gaugeframe.llm import ngram_join

    counts, whole = [], ngram_join.written

    def counted(df, name):
        out = whole(df, name)
        if name == "pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    return counts


def test_near_copies_that_link_only_by_their_base(spark, formed):
    """300 copies of 200 words with five words changed each: mostly under the threshold to each
    other, all over it to the base."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    docs = [(0, " ".join(base))]
    for k in range(1, 301):
        words = list(base)
        for at in rng.sample(range(200), 5):
            words[at] = f"x{k}.{at}"
        docs.append((k, " ".join(words)))
    rng.shuffle(docs)
    got = similar_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(docs)
    assert sum(formed) <= 20 * len(docs)


def test_documents_that_share_a_passage(spark, formed):
    """500 documents with one passage of 30 words and 12 to 60 of their own: few links or none."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(k, " ".join(f"d{k}.{j}" for j in range(rng.randint(4, 60))) + " " + passage) for k in range(500)]
    got = similar_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(docs)
    assert sum(formed) <= 20 * len(docs)


def test_registered_query(spark):
    from gaugeframe.llm.ngram_join import op4_ngram_join

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id)) for r in op4_ngram_join(spark, folder).collect()]
    assert sorted(got) == brute(docs) and any(d != c for d, _, c in got)


def test_overlaps_are_counted_in_small_pieces():
    """A batch of 40 MB of fragments is not unpacked at once."""
    held = np.arange(512, dtype=np.uint64)
    n = 5_000
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int64()),
         pa.array([held.tobytes()] * n, pa.binary()), pa.array([(held + np.uint64(i)).tobytes() for i in range(n)], pa.binary())],
        names=["a", "b", "need", "left", "right"])
    tracemalloc.start()
    try:
        out = pa.Table.from_batches(_count_overlap(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out["overlap"].to_pylist() == [max(0, 512 - i) for i in range(n)]
    assert out["a"].to_pylist() == list(range(n))
    assert peak < 10 << 20
