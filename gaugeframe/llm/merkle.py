"""A Merkle manifest of a table: a tree of rows for each group, a tree of the groups' roots on top.

A leaf is the SHA-256 of a row's columns, each written as ``-`` if null, else as its UTF-8 byte
count, a colon and the value. In each group leaves lie in order; every ``FAN`` consecutive nodes of
a level (the last run may have fewer, even one) become the digest of their joined hex texts, until
one node remains. A lone leaf is its group's root as it is.

Nodes are kept as an append log in postorder, the order in which they are completed. Aligned
builders each take ``FAN ** LEVELS`` leaves, whose nodes lie next to each other in that order; the
roots of full builders are the leaves of the next tier. Where a node lies follows from the sizes of
the subtrees before it alone (``position``), so that a proof reads its siblings from the log by
address, and no task ever holds more than one builder's nodes.

Groups are ordered by name, null first. Rows of a group with equal order are ordered by digest, so
repeated rows have neighbouring leaves and a proof each. Null values are hashed as ``-``. An empty
table has an empty log and no root. Columns that are not named are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written

# Children of a node, bytes of a digest.
FAN = 3
SIZE = 32
#: Levels of one builder: 2,187 leaves at most.
LEVELS = 7


# ---- the tree's arithmetic

def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def position(leaves: int, top: int, level: int, index: int) -> int:
    """Place in postorder of a node, in a tree of ``leaves`` that is ``top`` levels high. All
    nodes at its level and below are done up to its last leaf; above it, all that end before its
    first leaf."""
    upto = min((index + 1) * FAN ** level, leaves)
    done = sum(-(-upto // FAN ** x) for x in range(level + 1))
    return done + sum(index // FAN ** x for x in range(1, top - level + 1)) - 1


def joined(digests: bytes) -> bytes:
    """The digest of the hex texts of digests."""
    return hashlib.sha256(digests.hex().encode()).digest()


def append_log(leaves: list[bytes], top: int) -> bytes:
    """The nodes of a tree of ``top`` levels in the order of completion."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(top + 1)]

    def put(node: bytes, level: int) -> None:
        log.append(node)
        open_runs[level].append(node)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        put(joined(b"".join(run)), level + 1)

    for leaf in leaves:
        put(leaf, 0)
        level = 0
        while level < top and len(open_runs[level]) == FAN:
            close(level)
            level += 1
    for level in range(top):  # the last run of a level may be short
        if open_runs[level]:
            close(level)
    return b"".join(log)


def siblings(log: bytes, leaves: int, top: int, index: int) -> bytes:
    """The other nodes of each run on the way up from a leaf, level by level, left to right."""
    found, count = [], leaves
    for level in range(top):
        first = index - index % FAN
        for i in range(first, min(first + FAN, count)):
            if i != index:
                at = SIZE * position(leaves, top, level, i)
                found.append(log[at:at + SIZE])
        index, count = index // FAN, -(-count // FAN)
    return b"".join(found)


def fold(digest: bytes, path: bytes, *trees: tuple[int, int]) -> bytes:
    """The root that a leaf and its siblings give; ``trees`` are (index, leaves) of the leaf in its
    tree and of that tree's root in the next."""
    at = 0
    for index, count in trees:
        while count > 1:
            own, run = index % FAN, min(FAN, count - (index - index % FAN))
            parts = [path[at + SIZE * i:at + SIZE * (i + 1)] for i in range(run - 1)]
            digest, at = joined(b"".join([*parts[:own], digest, *parts[own:]])), at + SIZE * (run - 1)
            index, count = index // FAN, -(-count // FAN)
    return digest


# ---- building

def leaf_digest(*columns: str | Column) -> Column:
    """SHA-256 of the columns of a row, as lowercase hex."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass
class Forest:
    """Trees, tier by tier: (tree, block, n, members, nodes) for each builder; ``n`` is the number
    of the tree's leaves in that tier, ``nodes`` the builder's log."""

    tiers: list[DataFrame]
    levels: int

    def roots(self) -> DataFrame:
        """(tree, n, root) of every tree, ``n`` by its own leaves."""
        span = FAN ** self.levels
        last = [t.filter(F.col("n") <= span).select("tree", F.expr(f"substring(nodes, -{SIZE}, {SIZE})").alias("root"))
                for t in self.tiers]
        roots = last[0]
        for more in last[1:]:
            roots = roots.unionByName(more)
        sizes = self.tiers[0].filter("block = 0").select(F.col("tree").alias("of"), "n")
        return roots.join(sizes, F.col("tree").eqNullSafe(F.col("of"))).select("tree", "n", "root")


@dataclass
class Manifest:
    """The trees of the groups, the tree of their roots, and (tree, n, root, place) per group."""

    groups: Forest
    top: Forest
    roots: DataFrame

    def root(self) -> Column:
        """The manifest's root in hex, null for an empty table."""
        return F.lower(F.hex(self.top.roots().agg(F.first("root").alias("r")).scalar()))

    def log(self) -> DataFrame:
        """(tree, position, digest) of all nodes of the groups' trees."""
        out = None
        for t, tier in enumerate(self.groups.tiers):
            rows = tier.join(self.roots.select(F.col("tree").alias("of"), F.col("n").alias("all")),
                             F.col("tree").eqNullSafe(F.col("of")))
            rows = rows.select("tree", "block", "n", "all", "nodes").mapInArrow(
                _addressed(t, self.groups.levels), f"tree {dict(tier.dtypes)['tree']}, position bigint, digest string")
            out = rows if out is None else out.unionByName(rows)
        return out


def _builder_top(n: int, levels: int) -> int:
    """A builder that is not alone always makes all its levels."""
    return height(n) if n <= FAN ** levels else levels


def _addressed(tier: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, n, whole, nodes = (batch.column(c)[i].as_py() for c in ("block", "n", "all", "nodes"))
                span, top = FAN ** levels, _builder_top(n, levels)
                held, at, digests = min(span, n - block * span), [], []
                for level in range(1 if tier else 0, top + 1):  # a tier's leaves are nodes of the one below
                    for index in range(-(-held // FAN ** level)):
                        place = SIZE * position(held, top, level, index)
                        digests.append(nodes[place:place + SIZE].hex())
                        at.append(position(whole, height(whole), tier * levels + level,
                                           block * span // FAN ** level + index))
                tree = pa.array([batch.column("tree")[i].as_py()] * len(at), batch.schema.field("tree").type)
                yield pa.RecordBatch.from_arrays([tree, pa.array(at, pa.int64()), pa.array(digests, pa.string())],
                                                 names=["tree", "position", "digest"])
    return run


def ranked(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """``leaves`` with ``rank`` in their tree (from 0) and ``n``, its number of leaves. Rows are
    dealt by ranges of tree and order, and numbered from the sizes of the parts before, so that no
    tree is sorted by one task."""
    rows = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("at", 33)
    parts = rows.groupBy(F.col("tree").alias("of"), part.alias("part")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    tree = Window.partitionBy("of")
    parts = parts.withColumn("n", F.sum("held").over(tree)).withColumn("before", F.coalesce(F.sum("held").over(
        tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("held")
    found = rows.join(parts, F.col("tree").eqNullSafe(F.col("of")) & (part == F.col("part")))
    return found.withColumn("rank", F.col("at") - F.col("first") + F.col("before")).drop("at", "of", "part", "first", "before")


def build_forest(leaves: DataFrame, levels: int = LEVELS) -> Forest:
    """Trees over (tree, rank, n, digest, ...); further columns stay with the first tier's members."""
    span, kept = FAN ** levels, [c for c in leaves.columns if c not in ("tree", "n", "rank", "digest")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, members in zip(batch.column("n").to_pylist(), batch.column("members")):
                digests = pa.array(members.values.field("digest")).to_pylist()
                logs.append(append_log(digests, _builder_top(n, levels)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.binary())],
                                             names=[*batch.schema.names, "nodes"])

    tiers: list[DataFrame] = []
    while not tiers or not tiers[-1].filter(F.col("n") > span).isEmpty():
        if tiers:  # roots of full builders are the next leaves
            leaves = tiers[-1].filter(F.col("n") > span).select(
                "tree", F.col("block").alias("rank"), F.ceil(F.col("n") / span).alias("n"),
                F.expr(f"substring(nodes, -{SIZE}, {SIZE})").alias("digest"))
            kept = []
        # A group holds the leaves of one builder, a fixed number at most.
        built = leaves.groupBy("tree", F.floor(F.col("rank") / span).alias("block")).agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "digest", *kept))).alias("members"))
        schema = ", ".join(f"{c} {t}" for c, t in built.dtypes)
        tiers.append(written(built.mapInArrow(build, f"{schema}, nodes binary"), "merkle-log"))
    return Forest(tiers, levels)


def merkle_manifest(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of (tree, key, digest in hex, ...): a tree per value of ``tree``, ordered by
    ``key`` and then digest. Further columns are carried to the proofs."""
    rows = rows.withColumn("digest", F.unhex("digest"))
    groups = build_forest(ranked(rows, [F.col("key"), F.col("digest")]), levels)
    roots = written(groups.roots(), "merkle-roots")
    # One tree over all groups, whose leaves are dealt by range as well.
    tops = ranked(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")),
                  [F.col("name")])
    tops = written(tops, "merkle-tops")
    places = tops.select(F.col("name").alias("of"), F.col("rank").alias("place"))
    roots = roots.join(places, F.col("tree").eqNullSafe(F.col("of"))).drop("of")
    return Manifest(groups, build_forest(tops, levels), roots)


# ---- proofs

def _paths(forest: Forest, above: DataFrame | None) -> DataFrame:
    """The first tier's builders with ``above``, the siblings over each builder's root:
    (tree, block, n, members, nodes, above). The given ``above`` (tree, path) continues the path
    over the roots of whole trees."""
    span, levels = FAN ** forest.levels, forest.levels

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, n, nodes, over = (batch.column(c)[i].as_py() for c in ("block", "n", "nodes", "above"))
                held, top = min(span, n - block * span), _builder_top(n, levels)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("tree")[i].as_py()] * held, batch.schema.field("tree").type),
                    pa.array(range(block * span, block * span + held), pa.int64()),
                    pa.array([siblings(nodes, held, top, x) + over for x in range(held)], pa.binary())],
                    names=["tree", "block", "path"])

    below: DataFrame | None = None
    for t in reversed(range(len(forest.tiers))):
        tier = forest.tiers[t]
        kind = dict(tier.dtypes)["tree"]
        ends = tier.filter(F.col("n") <= span)
        if above is None:
            found = ends.withColumn("above", F.lit(b""))
        else:
            ended = above.select(F.col("tree").alias("of"), F.col("path").alias("above"))
            found = ends.join(ended, F.col("tree").eqNullSafe(F.col("of"))).drop("of")
        if below is not None:
            over = below.select(F.col("tree").alias("of"), F.col("block").alias("at"), F.col("path").alias("above"))
            found = found.unionByName(tier.filter(F.col("n") > span).join(
                over, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at"))
        if t == 0:
            return found
        below = found.select("tree", "block", "n", "nodes", "above").mapInArrow(
            climb, f"tree {kind}, block bigint, path binary")
    raise AssertionError("a forest has a tier")


def extract_proofs(manifest: Manifest) -> DataFrame:
    """A row per leaf: (tree, rank, n, leaf, path, root, place, trees, ...): its digest, the
    siblings on the way to the manifest's root as joined digests, its tree's root, and that root's
    place among ``trees``."""
    kind = dict(manifest.roots.dtypes)["tree"]
    member = manifest.groups.tiers[0].schema["members"].dataType.elementType
    kept = [f for f in member.fields if f.name not in ("rank", "digest")]
    top_levels, levels = manifest.top.levels, manifest.groups.levels

    def top_path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, nodes, over = (batch.column(c)[i].as_py() for c in ("n", "nodes", "above"))
                members, top = batch.column("members")[i].values, _builder_top(n, top_levels)
                paths = [siblings(nodes, len(members), top, x) + over for x in range(len(members))]
                yield pa.RecordBatch.from_arrays([members.field("name"), pa.array(paths, pa.binary())],
                                                 names=["tree", "path"])

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, nodes, over = (batch.column(c)[i].as_py() for c in ("n", "nodes", "above"))
                members = batch.column("members")[i].values
                held, top = len(members), _builder_top(n, levels)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("tree")[i].as_py()] * held, batch.schema.field("tree").type),
                    members.field("rank"), pa.array([n] * held, pa.int64()), members.field("digest"),
                    pa.array([siblings(nodes, held, top, x) + over for x in range(held)], pa.binary()),
                    *[members.field(f.name) for f in kept]],
                    names=["tree", "rank", "n", "leaf", "path", *[f.name for f in kept]])

    above = _paths(manifest.top, None).select("n", "nodes", "above", "members").mapInArrow(
        top_path, f"tree {kind}, path binary")
    builders = _paths(manifest.groups, above)
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept)
    proofs = builders.select("tree", "n", "nodes", "above", "members").mapInArrow(
        prove, f"tree {kind}, rank bigint, n bigint, leaf binary, path binary{more}")
    trees = manifest.roots.agg(F.count(F.lit(1)).alias("c")).scalar()
    ends = manifest.roots.select(F.col("tree").alias("of"), "root", "place")
    return proofs.join(ends, F.col("tree").eqNullSafe(F.col("of"))).drop("of").withColumn("trees", trees)


def fold_proofs(proofs: DataFrame, digest_col: str) -> DataFrame:
    """``proofs`` with ``folded``: the root that the digest in this column (binary) gives with the
    path; null digests give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            needed = [batch.column(c).to_pylist() for c in (digest_col, "path", "rank", "n", "place", "trees")]
            folded = [None if d is None else fold(d, path, (rank, n), (place, trees))
                      for d, path, rank, n, place, trees in zip(*needed)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.binary())],
                                             names=[*batch.schema.names, "folded"])

    schema = ", ".join(f"`{c}` {t}" for c, t in proofs.dtypes)
    return proofs.mapInArrow(run, f"{schema}, folded binary")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = F.when(tampers, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaf, claimed = (leaf_digest("doc_id", "source", "lang", "n_chars", text) for text in ("text", changed))
    # The digests are written first, so that the texts are read and hashed once.
    rows = written(docs.select(F.col("source").alias("tree"), F.col("doc_id").alias("key"), leaf.alias("digest"),
                               F.unhex(claimed).alias("claimed")), "merkle-digests")
    manifest = merkle_manifest(rows)
    folded = fold_proofs(extract_proofs(manifest), "claimed")

    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    out = folded.select(F.col("key").alias("doc_id"), text("leaf").alias("leaf"), text("root").alias("subroot"),
                        manifest.root().alias("root"), F.sha2(text("path").cast("binary"), 256).alias("proof_sha256"),
                        text("folded").alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = """
WITH RECURSIVE
crc_steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tbl FROM crc_steps WHERE k = 8),
docs AS (
  SELECT doc_id, source, lang, n_chars, text, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
             lambda ch: ascii(ch)::BIGINT)), lambda a, b: xor(a // 256, tbl[xor(a, b) % 256 + 1])), 4294967295) AS crc
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS idx,
         sha256(concat(d, s, l, n, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
         sha256(concat(d, s, l, n, CASE WHEN text IS NULL THEN '-' WHEN crc % 2 = 0
             THEN concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), ''))
             ELSE concat(strlen(text), ':', text) END)) AS claimed
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS d, coalesce(strlen(source) || ':' || source, '-') AS s,
               coalesce(strlen(lang) || ':' || lang, '-') AS l, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n
        FROM docs)),
nodes(tree, level, idx, digest) AS (
  SELECT tree, 0, idx, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS width FROM nodes) WHERE width > 1 GROUP BY tree, level, idx // 3),
subroots AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM nodes GROUP BY tree),
tops(level, idx, digest) AS (
  SELECT 0, tree, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS width FROM tops) WHERE width > 1 GROUP BY level, idx // 3),
runs AS (
  SELECT tree, level AS step, idx // 3 AS run, list(nodes.digest ORDER BY idx) AS digests
  FROM nodes JOIN subroots s USING (tree) WHERE level < s.height GROUP BY ALL
  UNION ALL
  SELECT NULL, level, idx // 3, list(digest ORDER BY idx) FROM tops
  WHERE level < (SELECT max(level) FROM tops) GROUP BY ALL),
walk AS (
  SELECT doc_id, tree, idx, leaf, claimed, height, unnest(range(0, height + (SELECT max(level) FROM tops))) AS step
  FROM leaves JOIN subroots USING (tree)),
steps AS (
  SELECT w.*, CASE WHEN step < height THEN idx // (3 ** step)::BIGINT ELSE tree // (3 ** (step - height))::BIGINT END AS spot
  FROM walk w),
met AS (
  SELECT s.*, digests FROM steps s JOIN runs r ON r.tree IS NOT DISTINCT FROM CASE WHEN s.step < height THEN s.tree END
    AND r.step = CASE WHEN s.step < height THEN s.step ELSE s.step - height END AND r.run = s.spot // 3),
proofs AS (
  SELECT doc_id, tree, idx, list(digests ORDER BY step) AS runs, list(spot % 3 ORDER BY step) AS places,
         string_agg(array_to_string(list_concat(digests[:spot % 3], digests[spot % 3 + 2:]), ''), '' ORDER BY step) AS path
  FROM met GROUP BY doc_id, tree, idx),
folds AS (
  SELECT l.doc_id, l.tree, l.leaf, coalesce(path, '') AS path, coalesce(len(runs), 0) AS n,
         list_reduce(list_prepend(claimed, coalesce(list_transform(range(1, len(runs) + 1), lambda i: array_to_string(
           list_concat(runs[i][:places[i]], ['?'], runs[i][places[i] + 2:]), '')), [])),
           lambda a, b: sha256(replace(b, '?', a))) AS folded
  FROM leaves l LEFT JOIN proofs p ON l.tree = p.tree AND l.idx = p.idx)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(path) AS proof_sha256, folded AS folded_root,
       folded = t.digest AS verified
FROM folds JOIN subroots s USING (tree), (SELECT arg_max(digest, level) AS digest FROM tops) t
"""
