"""Decontamination against brute force and the registered SQL."""

import random
import re

from gaugeframe.llm.decontaminate import OP1_SQL, contamination, op1_decontaminate
from oracle import compare, connect


def words(text):
    lowered = (text or "").encode().lower().decode()
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, size):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(len(w) - size, 0) + 1) if w else ():
            windows.setdefault(tuple(w[k:k + size]), set()).add("" if i is None else str(i))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k:k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= ids
        out.append((str(i), len(w), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out)


def check(spark, docs, items, size):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, id int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, window int")
    got = sorted((str(r.id), r.n_words, r.n_hit, r.n_items, ",".join(r["items"]))
                 for r in contamination(d, b, size=size).collect())
    assert got == brute(docs, items, size)


def test_random(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "çà", "É", "İx", "d1", "7"]
    text = lambda n: rng.choice([" ", "--", ". "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(0, 9))) for i in range(14)] + [(None, text(5)), (3, text(6)), (50, None), (51, "...")]
    docs = [(i, text(rng.randint(0, 40))) for i in range(40)] + [(None, text(20)), (1, text(9)), (60, None), (61, "?")]
    docs += [docs[0], (70, text(5000))]
    check(spark, docs, items, 4)


def test_long_items_and_empty_tables(spark):
    base = " ".join(f"w{i}" for i in range(40))
    items = [(1, base), (2, " ".join(base.split()[:9])), (2, base)]
    docs = [(1, "x " + base.upper() + " y"), (2, " ".join(base.split()[3:13])), (3, " ".join(base.split()[3:12]))]
    check(spark, docs, items, 10)
    check(spark, docs, [], 10)
    check(spark, [], items, 10)


def test_sql(spark, sf_dir):
    assert compare(op1_decontaminate(spark, sf_dir), connect(sf_dir), OP1_SQL) == []
