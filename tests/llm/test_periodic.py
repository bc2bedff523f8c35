"""Periodic runs against a search over all periods and places."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gaugeframe.llm.periodic import (
    group_fragments, long_enough, merged, op13_periodic_runs, periodic_runs, text_runs, tile_groups, z_function,
)


def plain_runs(w):
    """(start, length, period) by start and period."""
    n, seen = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                seen.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j
    return sorted((s, length, q) for (s, length), q in seen.items())


def collapsed(w, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def made(rng, n, letters):
    """Random words with repetitions of random stretches inside one another."""
    w = rng.integers(0, letters, n).tolist()
    for _ in range(int(rng.integers(0, 4))):
        a, p, e = int(rng.integers(0, n)), int(rng.integers(1, max(2, n // 6))), int(rng.integers(2, 9))
        stretch = w[a:a + p]
        w[a:a + p * e] = (stretch * e)[:len(w[a:a + p * e])]
    return w[:n]


def test_z_function():
    rng = np.random.default_rng(0)
    for n in range(30):
        s = rng.integers(0, 2, n).tolist()
        assert z_function(s) == [next((k for k in range(n - i) if s[k] != s[i + k]), n - i) for i in range(n)]


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_of_many_texts(letters):
    rng = np.random.default_rng(letters)
    texts = [made(rng, int(n), letters) for n in rng.integers(1, 260, 150)] + [[], [0] * 300, [0, 1] * 100, [0] * 6, [0] * 5]
    codes = np.array([c for t in texts for c in t], np.int64)
    bounds = np.cumsum([0, *map(len, texts)])
    found = [[] for _ in texts]
    for text, q, x, y in text_runs(codes, bounds):
        found[text].append((x, y - x + q, q))
    assert [sorted(f) for f in found] == [plain_runs(t) for t in texts]
    for t, f in zip(texts, found):  # the same in small groups of tiles
        for size in (1, 16):
            parts = [(0, *g) for o, first, count, some in tile_groups(np.array(t, np.int32), size)
                     for g in group_fragments(some, o, first, count)]
            assert sorted((x, y - x + q, q) for _, q, x, y in merged(parts) if long_enough(q, x, y)) == sorted(f)


def words(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")


def expected(text):
    w = words(text)
    runs = plain_runs(w)
    left = collapsed(w, runs)
    return len(w), runs, left if runs else None, hashlib.sha256(left.encode()).hexdigest()


def found(df):
    return [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.collapsed_sha256) for r in df.collect()]


@pytest.mark.parametrize("group", [8, 100, 1 << 18])
def test_operator(spark, group):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{c}é" for c in made(rng, 120, 3))) for i in range(25)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "a " * 2000), (104, "\x0b a a\fa a a a \x1c  "),
             (None, "x y " * 30), (None, "x y " * 30), (105, "b" * 50_000), (0, rows[0][1]), (0, "other " * 7),
             (106, "  lead a b a b a b a b\n")]
    df = spark.createDataFrame([(t, i, 1, "z") for i, t in rows], "text string, doc_id bigint, fp int, runs string")
    got = found(periodic_runs(df.repartition(3), group_words=group))
    assert sorted(got, key=str) == sorted(((i, *expected(t)) for i, t in rows), key=str)


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def with_repeats(i, text):
    w, h = words(text), zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
    return " ".join(w)


def check_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, text in docs:
        _, runs, _, digest = expected(with_repeats(i, text) if i is not None else text)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     hashlib.sha256(lines.encode()).hexdigest(), digest))
    got = op13_periodic_runs(spark, folder)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    return sum(w[1] > 0 for w in want)


def test_registered_query(spark, sf_dir):
    small = "/root/testdata/sf0.001" if sf_dir.endswith("sf0.01") else sf_dir  # the plain search is quadratic
    assert check_query(spark, small)


def test_query_with_nulls_and_repeated_rows(spark, tmp_path):
    rows = [(i, " ".join(f"w{j % 7 if i % 2 else j}" for j in range(i))) for i in range(60)]
    rows += [(None, None), (None, "a " * 9), (70, None), (71, ""), rows[30], rows[31]]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert check_query(spark, str(tmp_path))
