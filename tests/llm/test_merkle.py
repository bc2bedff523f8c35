"""Merkle manifests: closed-form places, digests, proofs and tampering against plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeframe.llm.merkle import (
    append_log, extract_proofs, fold, fold_proofs, height, leaf_digest, merkle_manifest, op12_merkle, position, siblings,
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return out


def postorder(levels):
    """Digests in order of completion, by recursion."""
    out = []

    def visit(level, index):
        if level:
            for child in range(index * 3, min(index * 3 + 3, len(levels[level - 1]))):
                visit(level - 1, child)
        out.append((level, index, levels[level][index]))

    visit(len(levels) - 1, 0)
    return out


def path_of(levels, index):
    out = []
    for level in levels[:-1]:
        first = index - index % 3
        out += [d for i, d in enumerate(level[first:first + 3], first) if i != index]
        index //= 3
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 9, 10, 26, 27, 28, 82, 100])
def test_log_and_places(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels, log = levels_of(leaves), append_log([bytes.fromhex(d) for d in leaves], height(n))
    order = postorder(levels)
    assert height(n) == len(levels) - 1
    assert log.hex() == "".join(d for _, _, d in order)
    assert [position(n, height(n), level, i) for level, i, _ in order] == list(range(len(order)))
    for i in range(n):
        path = siblings(log, n, height(n), i)
        assert path.hex() == "".join(path_of(levels, i))
        assert fold(bytes.fromhex(leaves[i]), path, (i, n), (0, 1)).hex() == levels[-1][0]


def plain(rows):
    """(tree, key, digest) rows to their (subroot, root, path)."""
    groups = {}
    for tree, key, digest in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(tree, []).append((key, digest))
    trees = [levels_of([d for _, d in g]) for g in groups.values()]
    top = levels_of([t[-1][0] for t in trees])
    return sorted(((tree, key, digest, levels[-1][0], top[-1][0], "".join(path_of(levels, i) + path_of(top, g)))
                   for g, ((tree, members), levels) in enumerate(zip(groups.items(), trees))
                   for i, (key, digest) in enumerate(members)), key=str)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_proofs(spark, levels):
    rows = [(None if g == 3 else f"s{g}é", None if i == 5 else i, sha(f"{g}-{i}")) for g, n in
            enumerate([1, 2, 40, 9, 10, 3, 1, 28, 1, 1, 1]) for i in range(n)]
    rows += [rows[10], rows[10], ("s2é", 7, sha("other")), ("", 1, sha("x"))]
    df = spark.createDataFrame(rows, "tree string, key bigint, digest string").withColumn("claimed", F.unhex("digest"))
    manifest = merkle_manifest(df.repartition(5), levels)
    got = fold_proofs(extract_proofs(manifest), "claimed").withColumn("top", manifest.root()).collect()
    assert sorted(((r.tree, r.key, bytes(r.leaf).hex(), bytes(r.root).hex(), r.top, bytes(r.path).hex()) for r in got),
                  key=str) == plain(rows)
    assert {bytes(r.folded).hex() for r in got} == {got[0].top}
    groups = {}
    for tree, key, digest in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(tree, []).append(digest)
    want = {(t, at, d) for t, g in groups.items() for at, (_, _, d) in enumerate(postorder(levels_of(g)))}
    log = [tuple(r) for r in manifest.log().collect()]
    assert len(log) == len(want) and set(log) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "tree string, key bigint, digest string")
    manifest = merkle_manifest(df)
    assert extract_proofs(manifest).count() == 0 and manifest.log().count() == 0
    assert spark.range(1).select(manifest.root().alias("r")).first().r is None


def test_leaves_of_null_empty_and_long_values(spark):
    rows = [(None, None), (1, ""), (-2, "é\n"), (3, "x" * 300_000)]
    got = spark.createDataFrame(rows, "a bigint, b string").select(leaf_digest("a", "b").alias("d")).collect()
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    assert [r.d for r in got] == [sha(field(a) + field(b)) for a, b in rows]


def test_query_with_nulls_and_repeated_rows(spark, tmp_path):
    rows = [(i, f"t\n{i}" if i % 3 else None, "en" if i % 2 else None, None if i % 5 == 0 else "big", i) for i in range(40)]
    rows += [rows[7], (None, "a\nb", "en", "big", 3), (99, "x", None, "Z", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.withColumn("digest", F.lit(1)).withColumn("tree", F.lit(2)).write.parquet(str(tmp_path / "documents.parquet"))

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))

    by_leaf = {}
    for tree, key, digest, subroot, root, path in plain([(r[3], r[0], leaf(r, r[1])) for r in rows]):
        by_leaf[digest] = (subroot, root)
    got = op12_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in rows:
        found = [g for g in got if g.leaf == leaf(r, r[1])]
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None and "\n" in r[1]
        assert found and {(g.subroot, g.root) for g in found} == {by_leaf[leaf(r, r[1])]}
        assert {g.verified for g in found} == {not tampered}
        assert all((g.folded_root == g.root) == g.verified for g in found)


def test_registered_query(spark, sf_dir):
    """Every column against plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))

    want = {}
    for tree, key, digest, subroot, root, path in plain([(r.source, r.doc_id, leaf(r, r.text)) for r in docs]):
        want[key] = (digest, subroot, root, sha(path))
    tampered = {r.doc_id for r in docs if zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (r.text or "")}
    got = op12_merkle(spark, sf_dir).collect()
    assert {g.doc_id: (g.leaf, g.subroot, g.root, g.proof_sha256) for g in got} == want and len(got) == len(docs)
    assert {g.doc_id for g in got if not g.verified} == tampered and tampered
