"""N-gram Jaccard join by vertical partitioning.

The set of a document is its distinct shingles of five words (its whole word sequence, if it has
fewer), as 64-bit hashes. Documents with equal sets form one class, found by a hash of the set.

The global order of shingles is rare first: by how often a shingle's bucket, of a fixed number
of buckets, occurs in the documents, then by hash. Sets that reach the threshold share a shingle
among the first ``n - ceil(0.75 n) + 1`` of either set in that order, so those shingles give the
candidates. To decide a pair, the order is cut into fragments, the overlap is counted in each
fragment by itself, and the counts are summed per pair.

Pairs within a group of near copies are not all formed. In rounds, each class meets one central
leader of every shingle that it shares; classes already linked that way are one component. Once a
round links hardly any, pairs of classes that share a shingle and still lie in different components
are formed, so every link between different components is found and the components are exact.

A text without words, or null, has an empty set and no link. Rows with equal id and text are one
document in the result's components, each its own row. Null ids take part, but do not name a
component unless it has no other id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.skew import attach_by_key
from .components import components
from .shared import written
from .text import blocks, hash_words, mixed, split_words, text_column

SHINGLE = 5
PERCENT = 75  # 100 * intersection >= PERCENT * union
BUCKETS = 1 << 20
SLICES = 64  # pieces in which bucket counts are summed
FRAGMENTS = 4
SPLIT_ROWS = 200_000  # a shingle that occurs more often is dealt out over several groups
BROADCAST_CLASSES = 1_000_000
STAR_SHARE = 50  # star rounds go on while one in so many of their pairs is linked
WORDS = 4  # 64-bit words of a class's bitmap of prefix shingles
BITS = [f"b{k}" for k in range(WORDS)]
BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 512 << 10  # bytes of text that are hashed at once
PAIRS = 500  # fragments that are compared at once


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    codes, offsets, vocabulary = split_words(texts)
    if not len(codes):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes = hash_words(vocabulary)[codes]
    padded = np.r_[hashes, np.zeros(SHINGLE, np.uint64)]
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * BASE + padded[k:k + len(hashes)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in hashes[a:b]:
                    one = one * BASE + h
            out.append(mixed(np.array([one], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(held: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(held.tobytes())).view(np.int64)) if len(held) else 0


def _describe(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, fp, n, node) of each text; then the bucket counts of the whole task, in slices."""
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                sets = shingle_sets(text_column(block, "text"))
                every = np.concatenate(sets)
                seen += np.bincount((every & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                m = block.num_rows
                yield pa.RecordBatch.from_arrays(
                    [block.column("id"), block.column("fp"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) for s in sets], pa.int64()), pa.nulls(m, pa.int32()),
                     pa.nulls(m, pa.binary())], names=["id", "fp", "n", "node", "slice", "counts"])
        if seen.any():
            width = BUCKETS // SLICES
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, kind), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.nulls(SLICES, pa.int64()), pa.array(range(SLICES), pa.int32()),
                 pa.array([seen[i * width:(i + 1) * width].astype(np.int32).tobytes() for i in range(SLICES)],
                          pa.binary())], names=["id", "fp", "n", "node", "slice", "counts"])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS // SLICES, np.int64)
    for counts in table["counts"]:
        total += np.frombuffer(counts.as_py(), np.int32)
    total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
    return pa.table({"slice": pa.array([table["slice"][0].as_py()], pa.int32()),
                     "counts": pa.array([total.tobytes()], pa.binary())})


def _cuts(counts: np.ndarray) -> np.ndarray:
    """Where the global order is cut: bucket counts that part all occurrences about evenly."""
    weight = np.sort(counts[counts > 0])
    if not len(weight):
        return np.zeros(0, np.int64)
    reached = np.cumsum(weight)
    return weight[np.searchsorted(reached, reached[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS)]


def _count_overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PAIRS):
            part = batch.slice(start, PAIRS)
            left, right = part.column("left").to_pylist(), part.column("right").to_pylist()
            counts = [len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), True))
                      for a, b in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("a", "b", "need")], pa.array(counts, pa.int64())],
                names=["a", "b", "need", "overlap"])


def linked_pairs(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The (a, b) of (a, b, na, nb) whose sets reach the threshold: partial overlaps by fragment,
    summed per pair."""
    wanted = pairs.select("a", "b", F.expr(
        f"CAST(ceil({PERCENT}D * (na + nb) / {100 + PERCENT}D) AS BIGINT)").alias("need"))
    # Both sides of a pair read the same exchange of the segments.
    segments = segments.repartition("node")
    met = wanted.join(segments, F.col("b") == F.col("node")).select(
        "a", "b", "need", F.col("fragment").alias("part"), F.col("held").alias("right"))
    met = met.join(segments, (F.col("a") == F.col("node")) & (F.col("part") == F.col("fragment"))).select(
        "a", "b", "need", F.col("held").alias("left"), "right")
    partial = met.mapInArrow(_count_overlap, "a bigint, b bigint, need bigint, overlap bigint")
    whole = partial.groupBy("a", "b", "need").agg(F.sum("overlap").alias("overlap"))
    return whole.filter("overlap >= need").select("a", "b")


def _possible(x: str, y: str) -> Column:
    """Whether two classes that share a shingle at these places, and none before, can reach the
    threshold: by length, by what can still follow in the global order, and by the prefix shingles
    that they may share at most, after this place and in all. A bit that only one of them has set
    stands for a shingle that the other lacks."""
    def most(a: str, b: str) -> str:
        return f"({a}.degree - " + " - ".join(f"bit_count({a}.{w} & ~{b}.{w})" for w in BITS) + ")"

    rest, need = _bounds(f"{x}.n", f"{y}.n")
    return F.expr(f"""100 * least({x}.n, {y}.n) >= {PERCENT} * greatest({x}.n, {y}.n) AND
        {100 + PERCENT} * (least({x}.i, {y}.i) + least({x}.n - {x}.i, {y}.n - {y}.i))
        >= {PERCENT} * ({x}.n + {y}.n)
        AND least({x}.after, {y}.after, {most(x, y)}, {most(y, x)}) + {rest} >= {need}""")


def _bounds(na: str, nb: str) -> tuple[str, str]:
    """What two sets share beyond the end of a prefix at most, and what they must share in all."""
    return (f"({PERCENT} * greatest({na}, {nb}) + 99) DIV 100 - 1",
            f"({PERCENT} * ({na} + {nb}) + {99 + PERCENT}) DIV {100 + PERCENT}")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, fp (a hash of its text), n_shingles, component_id, the
    smallest id that it reaches by links, and group, a number of its component (null for an empty
    set), which tells components apart also where ids repeat."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("fp"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    described = written(rows.mapInArrow(
        _describe(to_arrow_type(kind)), f"id {kind.simpleString()}, fp bigint, n bigint, node bigint, "
        "slice int, counts binary"), "shingle-sets")
    sets = described.filter("slice IS NULL").select("id", "fp", "n", "node")
    slices = {r["slice"]: r["counts"] for r in described.filter("slice IS NOT NULL").select(
        "slice", "counts").groupBy("slice").applyInArrow(_add_up, "slice int, counts binary").collect()}
    counts = np.concatenate([np.frombuffer(slices[i], np.int32) for i in sorted(slices)]) if slices \
        else np.zeros(BUCKETS, np.int32)
    order = docs.sparkSession.sparkContext.broadcast(counts)  # of fixed size

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shingle, salt, node, place) of each different set of the task; ``place`` packs the
        size of the set and where in it the shingle stands."""
        often, met = order.value, set()
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                parts = []
                for held in shingle_sets(text_column(block, "text")):
                    n, node = len(held), set_hash(held)
                    if not n or node in met:
                        continue
                    met.add(node)
                    count = often[(held & np.uint64(BUCKETS - 1)).astype(np.int64)]
                    first = np.argsort(count, kind="stable")[:n - -(-PERCENT * n // 100) + 1]
                    split = count[first] // SPLIT_ROWS + 1
                    parts.append((held[first].view(np.int64), np.where(split > 1, 1 + (node & 0x7FFFFFFF) % split, 0),
                                  np.full(len(first), node), (n << 32) + np.arange(len(first))))
                if parts:
                    columns = [np.concatenate(c) for c in zip(*parts)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(columns[2]),
                         pa.array(columns[3])], names=["shingle", "salt", "node", "place"])

    # One exchange serves both sides, as both read the same columns. A frequent shingle is dealt
    # over several groups and always kept.
    token = rows.select("text").mapInArrow(prefixes, "shingle bigint, salt int, node bigint, place bigint")
    token = token.repartition("shingle", "salt")
    met = token.groupBy("shingle", "salt").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.max("place").alias("place"))
    met = met.filter("(low < high OR salt > 0) AND place >= 0").select("shingle", "salt")
    shared = token.join(met, ["shingle", "salt"]).select(
        "shingle", "node", F.shiftright("place", 32).cast("int").alias("n"),
        F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("i"))
    shared = written(shared.distinct(), "shared")

    # The sets of the classes to compare, cut into fragments of the global order.
    cuts = _cuts(counts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = order.value
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                out = []
                for node, held in zip(block.column("node").to_pylist(), shingle_sets(text_column(block, "text"))):
                    part = np.searchsorted(cuts, often[(held & np.uint64(BUCKETS - 1)).astype(np.int64)])
                    out += [(node, int(k), held[part == k].tobytes()) for k in np.unique(part)]
                nodes, parts, helds = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(parts, pa.int32()), pa.array(helds, pa.binary())],
                    names=["node", "fragment", "held"])

    one = written(sets.filter("n > 0").groupBy("node").agg(F.min(F.struct("id", "fp")).alias("of")).select(
        "node", F.col("of.id").alias("_id"), F.col("of.fp").alias("_fp")), "classes")
    repeated = not sets.filter("n > 0").groupBy("id", "fp").count().filter("count > 1").isEmpty()

    def segments_of(pairs: DataFrame) -> DataFrame:
        """(node, fragment, held) of the classes in the pairs."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = written(one.join(nodes, "node", "left_semi"), "wanted-classes")
        if wanted.count() <= BROADCAST_CLASSES:  # else the documents are shuffled to them
            wanted = F.broadcast(wanted)
        chosen = rows.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
        held = chosen.select("node", "text").mapInArrow(cut, "node bigint, fragment int, held binary")
        return held.dropDuplicates(["node", "fragment"]) if repeated else held

    links, grouped, turn = None, written(_collapsed(shared).withColumn("comp", F.col("node")), "groups"), 0
    last = False
    while True:
        live = grouped.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        live = live.filter("low < high").select("shingle")
        grouped = written(grouped.join(live, "shingle", "left_semi"), "groups")
        pairs = written(_cross_pairs(grouped) if last else _star_pairs(grouped, turn), "pairs")
        found = written(linked_pairs(pairs, segments_of(pairs)), "links")
        links = found if links is None else links.unionByName(found)
        if last:
            break
        if found.count() * STAR_SHARE <= pairs.count():  # leaders link little: what is left meets pair by pair
            last = True
        else:
            grouped, turn = _relabel(grouped, components(links)), turn + 1
    roots = components(links)

    per_class = sets.filter("n > 0").groupBy("node").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    rooted = per_class.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "node", "low", "copies", F.coalesce("root", "node").alias("root"))
    # A component may hold a third of all classes.
    whole = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    named = written(attach_by_key(rooted, whole, ["root"], "classes").select(
        "node", "copies", "component_id", F.col("root").alias("group")), "components")
    # One class may hold a third of all rows: heavy classes meet a bounded broadcast.
    full = attach_by_key(sets.filter("n > 0"), named, ["node"], "copies").select("id", "fp", "n", "component_id", "group")
    out = full.unionByName(sets.filter("n = 0").select("id", "fp", "n", F.col("id").alias("component_id"),
                                                       F.lit(None).cast("bigint").alias("group")))
    return out.withColumnRenamed("n", "n_shingles")


def _relabel(grouped: DataFrame, roots: DataFrame) -> DataFrame:
    """``grouped`` with the component that each class now belongs to."""
    named = roots.select(F.col("node").alias("of"), "root")
    return grouped.drop("comp").join(named, F.col("node") == F.col("of"), "left").select(
        "shingle", "node", "n", "i", "after", "degree", *BITS, F.coalesce("root", "node").alias("comp"))


def _collapsed(shared: DataFrame) -> DataFrame:
    """(shingle, node, n, i, after, degree, bits): of shingles that the same classes hold only one is
    kept and counts for all; a passage has one list of classes and not one for each of its words.
    ``after`` is how many shared prefix shingles of the class come from this one on, ``degree`` is the number of shared prefix shingles of a class, ``b0`` and so on a bit for each
    of them by its hash."""
    lists = shared.groupBy("shingle").agg(
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y"),
        F.count(F.lit(1)).alias("size"))
    kept = lists.groupBy("x", "y", "size").agg(F.min("shingle").alias("shingle"), F.count(F.lit(1)).alias("weight"))
    bit = F.expr("shiftleft(1L, CAST(xxhash64(shingle) & 63 AS INT))")
    word = F.expr(f"shiftright(xxhash64(shingle), 6) & {WORDS - 1}")
    degrees = shared.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), *[
        F.coalesce(F.bit_or(F.when(word == k, bit)), F.lit(0).cast("bigint")).alias(f"b{k}") for k in range(WORDS)])
    after = F.sum("weight").over(Window.partitionBy("node").orderBy("i").rowsBetween(0, Window.unboundedFollowing))
    return shared.join(kept.select("shingle", "weight"), "shingle").join(degrees, "node").select(
        "shingle", "node", "n", "i", after.alias("after"), "degree", *BITS)


def _largest(grouped: DataFrame) -> DataFrame:
    """(shingle, most): the component with the most classes of each shingle."""
    held = grouped.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("size"))
    return held.groupBy("shingle").agg(F.max_by("comp", F.struct("size", "comp")).alias("most"))


def _star_pairs(grouped: DataFrame, turn: int) -> DataFrame:
    """Each class with the leaders of shingles it shares, where the two are not yet one component
    and can reach the threshold. A leader is central: near copies differ from
    their base less than from each other, and the base shares the most shingles. After the first
    round leaders come from outside a shingle's largest component."""
    inside = grouped.withColumn("out", F.lit(0))
    if turn:
        inside = grouped.join(_largest(grouped), "shingle").withColumn(
            "out", (F.col("comp") != F.col("most")).cast("int")).drop("most")
    best = F.struct("out", "degree", F.xxhash64("node").alias("rank"), "node", "n", "i", "comp", "after", *BITS)
    lead = inside.groupBy("shingle").agg(F.max(best).alias("l")).select("shingle", "l.*")
    met = grouped.alias("y").join(lead.alias("x"), "shingle")
    met = met.filter((F.col("x.comp") != F.col("y.comp")) & _possible("x", "y"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"),
                      F.col("y.n").alias("nb")).distinct()


def _cross_pairs(grouped: DataFrame) -> DataFrame:
    """All pairs of classes that share a shingle of their prefixes, can reach the threshold, and lie
    in different components. Members of a shingle's largest component do not meet each other."""
    rest = grouped.join(_largest(grouped), "shingle").filter(F.col("comp") != F.col("most"))
    met = rest.alias("x").join(grouped.alias("y"), "shingle")
    # Two that are both outside the largest component meet twice; one time counts.
    once = (F.col("y.comp") == F.col("x.most")) | (F.col("x.node") < F.col("y.node"))
    met = met.filter((F.col("x.comp") != F.col("y.comp")) & once & _possible("x", "y"))
    low = F.col("x.node") < F.col("y.node")
    return met.select(
        F.when(low, F.col("x.node")).otherwise(F.col("y.node")).alias("a"),
        F.when(low, F.col("y.node")).otherwise(F.col("x.node")).alias("b"),
        F.when(low, F.col("x.n")).otherwise(F.col("y.n")).alias("na"),
        F.when(low, F.col("y.n")).otherwise(F.col("x.n")).alias("nb")).distinct()


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
