"""Base scores against a plain count, and the tree as a probability distribution."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugeframe.llm.suffix_lm import DEPTH, EDGE, SHORT, codes_of, fit_suffix_tree, score_texts

SCHEMA = "doc_id bigint, text string, score string"
ROWS = [(1, "The cat sat on the mat", "x"), (2, None, "x"), (3, "", "x"), (4, "the  Dog\tsat\n", "x"),
        (4, "the  Dog\tsat\n", "x"), (None, "É unseen words", None), (6, "the cat " * 9000, "x")]


def tokens(text):
    lowered = (text or "").encode().lower().decode()
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w] + [None]


def test_base_and_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    learned = F.col("doc_id") != 4
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score < 0)
                 for r in score_texts(df, learned, chunk_bytes=100).collect())
    count = Counter(t for i, text, _ in ROWS if i is not None and i != 4 for t in tokens(text))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(t), sum(count[x] > 0 for x in t), n,
                   round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t), 6), True)
                  for i, t in ((i, tokens(text)) for i, text, _ in ROWS))
    assert got == want


def test_no_training_rows_and_empty(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for r in score_texts(df, F.lit(False)).collect():
        symbols = len((ROWS[[x[0] for x in ROWS].index(r.doc_id)][1] or "").encode()) + 1
        assert r.train_tokens == r.n_known == 0 and r.base_score == 0
        assert abs(r.score + symbols * math.log10(257)) < 1e-6 * symbols
    assert score_texts(df.limit(0), F.lit(True)).count() == 0


def test_tree_is_a_distribution_of_longest_suffixes(spark):
    df = spark.createDataFrame([("abracadabra " * 40,), ("abba baab",), ("xyz",)], "text string")
    tree = fit_suffix_tree(df, p_min=1e-3, gain=2.0)
    assert 0 < len(tree.contexts[1]) and all(len(c) <= 1000 for c in tree.contexts)
    for context in (b"abraca", b"zzzzzz", b"\xff\xff\xffaba", b"qqqabr"):
        head = sum(b << 8 * (DEPTH + 1 - k) for k, b in enumerate(reversed(context), 1))
        p = 10 ** tree.log10_probs(np.array([head | x for x in range(256)], np.uint64))
        # 257 symbols: the 256 byte values, of which the edge stands for the end, and one unused.
        assert 0.99 < p.sum() <= 1.0 + 1e-9
    for k in range(2, DEPTH + 1):  # every suffix of a retained context is retained
        assert set(tree.contexts[k] >> np.uint64(8)) <= set(tree.contexts[k - 1])
    codes, sizes = codes_of(pa.array(["Ab", ""], pa.large_string()))
    assert sizes.tolist() == [3, 1]
    assert [int(c) & 255 for c in codes] == [97, 98, EDGE, EDGE] and int(codes[1]) >> 48 == 97


def test_contexts_grow_with_the_corpus_and_ranges_agree(spark, monkeypatch):
    import random

    from gaugeframe.llm import suffix_lm

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 2 + rng.choice("xyz") for _ in range(30)) for _ in range(400)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    few, many = (fit_suffix_tree(df.filter(F.col("doc_id") < n), gain=0.0) for n in (40, 400))
    assert len(many.contexts[4]) > 1.5 * len(few.contexts[4])
    assert min(t.min() for t in many.totals[1:]) >= suffix_lm.LEAST
    # In many ranges and chunks, scores are those of the whole tree.
    monkeypatch.setattr(suffix_lm, "RANGE_CODES", 500)
    tree = fit_suffix_tree(df.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r.score for r in score_texts(df, F.col("doc_id") % 2 == 0, chunk_bytes=9000).collect()}
    codes, sizes = codes_of(pa.array(texts, pa.large_string()))
    want = np.add.reduceat(tree.log10_probs(codes), np.cumsum(sizes) - sizes)
    assert np.allclose([got[i] for i in range(400)], want)


def plain_scores(learned, texts, least, gain):
    """The model with dictionaries: counts of symbols by context, contexts retained from the longest
    down, each symbol scored by the longest retained suffix."""
    def steps(text):
        symbols = list((text or "").encode().lower()) + ["end"]
        past = ["edge"] * DEPTH
        for s in symbols:
            yield tuple(past), s
            past = past[1:] + [s]

    counts = [{} for _ in range(DEPTH + 1)]
    for text in learned:
        for past, s in steps(text):
            for k in range(DEPTH + 1):
                of = counts[k].setdefault(past[DEPTH - k:], {})
                of[s] = of.get(s, 0) + 1
    kept, below = [set() for _ in counts], set()
    for k in range(DEPTH, -1, -1):
        for context, seen in counts[k].items():
            total = sum(seen.values())
            if k <= SHORT:
                if total >= least or k == 0:
                    kept[k].add(context)
                continue
            parent = counts[k - 1][context[1:]]
            whole = sum(parent.values())
            diverges = sum(n * math.log(n / total / (parent[s] / whole)) for s, n in seen.items()) >= gain
            if total >= least and (diverges or context in below):
                kept[k].add(context)
        below = {c[1:] for c in kept[k]}
    out = []
    for text in texts:
        score = 0.0
        for past, s in steps(text):
            p = 1 / 257
            for k in range(DEPTH + 1):
                context = past[DEPTH - k:]
                if context not in kept[k]:
                    break
                seen = counts[k][context]
                p = (seen.get(s, 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
            score += math.log10(p)
        out.append(score)
    return out


def test_scores_are_those_of_plain_dictionaries(spark):
    rng = random.Random(6)
    words = ["ab", "abc", "Bcd", "é", "aab", "cab", "\n"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "never seen xyz"), (103, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for least, gain, chunk_bytes in ((2, 0.5, 1 << 20), (3, 2.0, 300)):
        got = {r.doc_id: r.score for r in score_texts(df, F.col("doc_id") % 5 != 0, least=least, gain=gain,
                                                      chunk_bytes=chunk_bytes).collect()}
        want = plain_scores([t for i, t in rows if i % 5], [t for _, t in rows], least, gain)
        for (i, _), w in zip(rows, want):
            assert abs(got[i] - w) <= 1e-6 * max(1.0, abs(w)), (i, got[i], w)


def test_registered_query(spark, tmp_path):
    from zlib import crc32

    from gaugeframe.llm.suffix_lm import GAIN, LEAST, op9_suffix_lm

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text").orderBy("doc_id").limit(40).collect()]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    held = {i for i, _ in rows if crc32(str(i).encode()) % 7 == 2}
    count = Counter(t for i, text in rows if i not in held for t in tokens(text))
    n, v = sum(count.values()), len(count)
    scores = plain_scores([t for i, t in rows if i not in held], [t for _, t in rows], LEAST, GAIN)
    got = {r.doc_id: r for r in op9_suffix_lm(spark, str(tmp_path)).collect()}
    for (i, text), score in zip(rows, scores):
        t, r = tokens(text), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(t), sum(count[x] > 0 for x in t), n)
        assert abs(r.base_score - sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)) < 1e-6 * max(1, -r.base_score)
        assert abs(r.score - score) < 1e-6 * max(1, -score)
