"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Nearness is the inner product. For the graph, vectors are lifted to equal length (one more
coordinate), where a larger inner product is a smaller distance, and held with 8 bits a
coordinate and a scale for each vector, so that a long vector costs short ones no precision;
distances take the added coordinate from the lengths. Searches begin at the query and at the
longest vectors. Scores of search results are computed in double precision from the vectors as given.

Equal vectors are one node with its smallest ids, as many as any result can need. First neighbours
come from blocks of neighbouring nodes in a few random orders (sign patterns of random
projections). Each round of NN-descent sends every node to its neighbours and to nodes that have
it as a neighbour; where nodes meet, those that are nearer to each other than what they know
become neighbours. Rounds end when few neighbours change.

A search keeps a pool of the best nodes seen and goes on from those not yet expanded, for all
queries in one join a step, until each query's pool is expanded.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows with a null id. Rows equal in id and vector count once. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import written

RESULTS = 20
NEIGHBOURS = 32  # of a node in the graph
REVERSE = 16  # nodes that have a node as neighbour, of which so many join it in a round
ORDERS = 24  # random orders that give first neighbours
BLOCK_NODES = 1024  # nodes of an order that are compared with each other
FIRST = 12  # neighbours that one order gives
ROUNDS = 6
STOP = 0.02  # share of neighbours that change
POOL = 64
EXPAND = 16  # nodes of its pool that a query expands in a step
STEPS = 16
ENTRIES = 32  # longest nodes, where every search begins, and others if its query is no node


@dataclass
class Index:
    """Nodes (node, vec bytes of ``kind``, members) and the graph (node, near array<bigint>)."""

    nodes: DataFrame
    graph: DataFrame
    size: int
    longest: list[int]
    kind: type


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Packed vectors as a matrix."""
    if not len(column):
        return np.zeros((0, 0), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def component_kind(table: DataFrame, vec_col: str) -> type:
    """float32 for a column of floats, which it holds as given, else float64."""
    return np.float32 if table.schema[vec_col].dataType.simpleString() == "array<float>" else np.float64


def packed_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, vectors as bytes of ``component_kind``."""
    held = component_kind(table, vec_col)
    rows = table.select(F.col(id_col).cast("bigint").alias("id"),
                        F.col(vec_col).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "size").first()
    width = size["size"] if size else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = [], []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                if None in v:
                    continue
                x = np.asarray(v, held) + held(0)  # -0 reads as 0
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vectors.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())],
                                             names=["id", "vec"])

    return rows.filter(F.size("v") == width).filter(F.lit(width > 0)).mapInArrow(pack, "id bigint, vec binary")


def _small(nodes: DataFrame, kind) -> DataFrame:
    """(node, small, length): 8 bits a coordinate after the scale of the vector (8 bytes), where
    the longest vector of all has length 1; and the length."""
    def longest(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), kind).astype(float)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([float(_lengths(x).max())])], names=["length"])

    most = nodes.select("vec").mapInArrow(longest, "length double").agg(F.max("length")).first()[0] or 1.0

    def reduce(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), kind).astype(float)
            if not len(x):
                continue
            top = np.abs(x).max(1)
            small = np.rint(x / top[:, None] * 127).astype(np.int8)
            scales = top / most / 127
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([c.tobytes() + s.tobytes() for c, s in zip(scales, small)], pa.binary()),
                 pa.array(_lengths(x) / most)], names=["node", "small", "length"])

    return nodes.select("node", "vec").mapInArrow(reduce, "node bigint, small binary, length double")


def _lengths(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1)
    return np.sqrt(np.square(x / top[:, None]).sum(1)) * top


def _scaled(column) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of 8 bits, as float32, and the scale of each vector."""
    held = np.frombuffer(b"".join(column), np.int8).reshape(len(column), -1)
    return held[:, 8:].astype(np.float32), np.ascontiguousarray(held[:, :8]).view(np.float64).reshape(-1)


def _similar(column) -> np.ndarray:
    """Minus the squared distance of lifted vectors, of each to each."""
    x, scales = _scaled(column)
    inner = (x @ x.T) * scales[:, None] * scales
    square = np.diag(inner).copy()
    extra = np.sqrt(np.maximum(1 - square, 0))
    # The difference of the added coordinates, from that of the squares where it is small.
    apart = (square - square[:, None]) / np.maximum(extra + extra[:, None], 1e-9)
    return -(np.maximum(square + square[:, None] - 2 * inner, 0) + apart * apart).astype(np.float32)


def _ordered(small: DataFrame, size: int) -> DataFrame:
    """(turn, key, node, small): every node once in each random order, at its place there."""
    bits = max(1, min(60, int(np.ceil(np.log2(max(size / BLOCK_NODES, 1)))) + 3))

    def place(batches):
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _scaled(batch.column("small").to_pylist())[0]
            if planes is None:
                planes = np.random.default_rng(0).normal(size=(ORDERS, x.shape[1], bits)).astype(np.float32)
            for turn in range(ORDERS):
                signs = ((x @ planes[turn]) > 0).astype(np.int64)
                key, flip = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
                for b in range(bits):  # a Gray code, so that neighbouring cells differ in one sign
                    flip = flip ^ signs[:, b]
                    key = key << 1 | flip
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), turn, np.int32)), pa.array(key), *batch.columns],
                    names=["turn", "key", "node", "small"])

    parts = max(1, -(-size * ORDERS // (32 * BLOCK_NODES)))
    placed = small.mapInArrow(place, "turn int, key bigint, node bigint, small binary")
    return placed.repartitionByRange(parts, "turn", "key", "node").sortWithinPartitions("turn", "key", "node")


OFFER = "node bigint, others binary, sims binary, old boolean"


def _offers(nodes, others, sims, old: bool) -> pa.RecordBatch:
    """Packed neighbours that are offered to each node."""
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([o.astype(np.int64).tobytes() for o in others], pa.binary()),
         pa.array([s.astype(np.float32).tobytes() for s in sims], pa.binary()),
         pa.array(np.full(len(nodes), old))], names=["node", "others", "sims", "old"])


def _meet_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of each node within its block of an order."""
    def best(ids, held):
        sims = _similar(held)
        np.fill_diagonal(sims, -np.inf)
        n = min(FIRST, len(ids) - 1)
        top = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        return _offers(ids, ids[top], np.take_along_axis(sims, top, 1), False)

    at, ids, held = None, np.zeros(0, np.int64), []
    for batch in batches:
        turns = batch.column("turn").to_numpy()
        for turn in np.unique(turns):
            if turn != at:
                if len(ids) > 1:
                    yield best(ids, held)
                at, ids, held = turn, np.zeros(0, np.int64), []
            a, b = np.searchsorted(turns, [turn, turn + 1])
            ids = np.r_[ids, batch.column("node").to_numpy()[a:b]]
            held = held + batch.column("small").slice(a, b - a).to_pylist()
            while len(ids) >= 2 * BLOCK_NODES:
                yield best(ids[:BLOCK_NODES], held[:BLOCK_NODES])
                ids, held = ids[BLOCK_NODES:], held[BLOCK_NODES:]
    if len(ids) > 1:
        yield best(ids, held)


def _nearest(offers: DataFrame, k: int) -> DataFrame:
    """(node, others, sims, new): the k nearest of all that is offered to a node, nearest first,
    and whether each is new to it."""
    listed = offers.groupBy("node").agg(F.collect_list(F.struct("others", "sims", "old")).alias("offers"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for offers in batch.column("offers"):
                offers = sorted(offers.as_py(), key=lambda o: not o["old"])
                others = np.frombuffer(b"".join(o["others"] for o in offers), np.int64)
                sims = np.frombuffer(b"".join(o["sims"] for o in offers), np.float32)
                known = sum(len(o["others"]) // 8 for o in offers if o["old"])
                other, first = np.unique(others, return_index=True)
                top = np.lexsort((other, -sims[first]))[:k]
                out[0].append(other[top])
                out[1].append(sims[first][top])
                out[2].append(first[top] >= known)
            kinds = (pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), *[pa.array(o, t) for o, t in zip(out, kinds)]],
                names=["node", "others", "sims", "new"])

    return listed.mapInArrow(merge, "node bigint, others array<bigint>, sims array<float>, new array<boolean>")


def _meet_at_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that meet offer themselves to each other where that improves on the worst known
    neighbour and one of the two is new there."""
    for batch in batches:
        nodes, others, sims_of = [], [], []
        for guests in batch.column("guests"):
            guests = guests.as_py()
            ids = np.array([g["node"] for g in guests])
            worst = np.array([g["worst"] for g in guests], np.float32)
            new = np.array([g["new"] for g in guests])
            sims = _similar([g["small"] for g in guests])
            good = (sims > worst[:, None]) & (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :])
            for i in np.flatnonzero(good.any(1)):
                nodes.append(ids[i])
                others.append(ids[good[i]])
                sims_of.append(sims[i, good[i]])
        yield _offers(nodes, others, sims_of, False)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [[np.array(x) for x in batch.column(c).to_pylist()] for c in ("others", "sims")]
        yield _offers(batch.column("node").to_pylist(), *lists, True)


def build_index(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                k: int = NEIGHBOURS, members: int = RESULTS + 1) -> Index:
    """An index of every row; equal vectors keep their ``members`` smallest ids."""
    kind = component_kind(table, vec_col)
    rows = packed_vectors(table, id_col, vec_col).distinct()
    rank = Window.partitionBy("vec").orderBy("id")
    kept = rows.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= members)
    nodes = kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members"))
    nodes = written(nodes.select(F.col("members")[0].alias("node"), "vec", "members"), "nodes")
    size = nodes.count()
    measured = written(_small(nodes, kind), "small-vectors")
    small = measured.select("node", "small")
    entries = [r["node"] for r in measured.orderBy(F.desc("length"), "node").limit(ENTRIES).collect()]
    graph = written(_nearest(_ordered(small, size).mapInArrow(_meet_in_blocks, OFFER), k), "graph")
    for _ in range(ROUNDS):
        edges = graph.select("node", F.inline(F.arrays_zip("others", "new"))).withColumnRenamed("others", "other")
        # A node goes to its neighbours, and some of those that have it come to it.
        turn = Window.partitionBy("host").orderBy(F.desc("new"), F.xxhash64("host", "node"))
        back = edges.select(F.col("other").alias("host"), "node", "new")
        back = back.withColumn("r", F.row_number().over(turn)).filter(F.col("r") <= REVERSE).drop("r")
        visits = edges.select(F.col("node").alias("host"), F.col("other").alias("node"), "new").unionByName(back)
        visits = visits.groupBy("host", "node").agg(F.max("new").alias("new"))
        worst = graph.select("node", F.when(F.size("sims") < k, F.lit(float("-inf"))).otherwise(
            F.array_min("sims")).cast("float").alias("worst")).join(small, "node")
        guests = visits.join(worst, "node").groupBy("host").agg(
            F.collect_list(F.struct("node", "small", "worst", "new")).alias("guests"))
        offers = guests.select("guests").mapInArrow(_meet_at_host, OFFER).unionByName(
            graph.select("node", "others", "sims").mapInArrow(_pack, OFFER))
        graph = written(_nearest(offers, k), "graph")
        changed = graph.agg(F.sum(F.size(F.filter("new", lambda x: x)))).first()[0] or 0
        if changed <= STOP * size * k:
            break
    # The search graph has the edges both ways, of the reverse ones the nearest k.
    edges = graph.select("node", F.inline(F.arrays_zip("others", "sims"))).withColumnRenamed("others", "other")
    turn = Window.partitionBy("other").orderBy(F.desc("sims"), "node")
    back = edges.withColumn("r", F.row_number().over(turn)).filter(F.col("r") <= k)
    both = edges.select("node", "other").unionByName(
        back.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return Index(nodes, written(both.groupBy("node").agg(F.collect_set("other").alias("near")), "graph"), size,
                 entries, kind)


def _inner(kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), kind).astype(float)
            x = _matrix(batch.column("vec"), kind).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("node"), pa.array((q * x).sum(1) if len(q) else np.zeros(0)),
                 pa.array(np.zeros(len(q), bool))], names=["query", "node", "score", "expanded"])
    return run


def search(index: Index, queries: DataFrame, pool: int = POOL) -> DataFrame:
    """(query, node, score) of the nodes seen for each query of (query bigint, q as in the nodes,
    start bigint); ``start`` is a node to begin at, or null."""
    entry = [r["node"] for r in index.nodes.select("node").orderBy(F.xxhash64("node")).limit(ENTRIES).collect()]
    listed = {k: F.array(*[F.lit(n) for n in v]).cast("array<bigint>") for k, v in
              (("any", entry), ("long", index.longest))}
    begin = F.when(F.col("start").isNotNull(), F.array("start")).otherwise(listed["any"])
    first = queries.select("query", "q", F.explode(F.array_union(begin, listed["long"])).alias("node"))

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(index.nodes.select("node", "vec"), "node").select("query", "node", "q", "vec").mapInArrow(
            _inner(index.kind), "query bigint, node bigint, score double, expanded boolean")

    seen = written(scored(first), "seen")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    for _ in range(STEPS):
        ranked = seen.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= pool)
        turn = Window.partitionBy("query").orderBy("r")
        open_ = ranked.filter(~F.col("expanded")).withColumn("o", F.row_number().over(turn)).filter(F.col("o") <= EXPAND)
        open_ = written(open_.select("query", "node"), "frontier")
        if open_.isEmpty():
            break
        reached = open_.join(index.graph, "node").select("query", F.explode("near").alias("node")).distinct()
        fresh = reached.join(seen.select("query", "node"), ["query", "node"], "left_anti")
        marked = seen.join(open_.withColumn("now", F.lit(True)), ["query", "node"], "left").select(
            "query", "node", "score", (F.col("expanded") | F.col("now").isNotNull()).alias("expanded"))
        seen = written(marked.unionByName(scored(fresh.join(queries.select("query", "q"), "query"))), "seen")
    return seen.select("query", "node", "score")


def nearest(table: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding",
            count: int = RESULTS) -> DataFrame:
    """The ``count`` nearest other rows of each row for which ``is_query``: (query_id, rank,
    vec_id, score), nearest first, ties to the smaller id."""
    index = build_index(table, id_col, vec_col, members=count + 1)
    asked = packed_vectors(table.filter(is_query), id_col, vec_col).distinct().select(
        F.col("id").alias("query_id"), "vec")
    # Queries with equal vectors are searched once.
    asked = written(asked.join(index.nodes.select("vec", "node"), "vec").select("query_id", "node"), "queries")
    queries = asked.select("node").distinct().join(index.nodes, "node").select(
        F.col("node").alias("query"), F.col("vec").alias("q"), F.col("node").alias("start"))
    found = search(index, queries)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= count + 1)
    rows = found.join(index.nodes.select("node", "members"), "node").select(
        "query", "score", F.explode("members").alias("vec_id"))
    listed = rows.groupBy("query").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
    listed = listed.select("query", F.slice("near", 1, (count + 1) * 2).alias("near"))
    out = asked.join(listed, asked["node"] == listed["query"]).select("query_id", F.slice(F.filter(
        "near", lambda x: x["vec_id"] != F.col("query_id")), 1, count).alias("near"))
    out = out.select("query_id", F.posexplode("near").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.far")).alias("score"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, F.col("vec_id") % 20 == 0)
