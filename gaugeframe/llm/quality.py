"""Quality classifier: an SVM on n-gram indicators scaled by naive Bayes log-count ratios.

Features are which byte trigrams a text holds and which pairs of word shapes follow each other,
hashed to a fixed number of dimensions. Their counts by class come from all labelled rows; the
hinge-loss model is fitted by dual coordinate descent, in one task, on a bounded sample. Margins
become scores by a logistic curve fitted on the same sample.

A null or empty text has no features and gets the score of margin 0. Rows with equal ids are
scored each for itself; a document with several labels counts once for each. If one class or
both have no row, the score is the share of class 1 (1/2 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .language_id import crc32_rest
from .shared import written
from .text import blocks, text_column, with_fields

BITS = 18
FIT_ROWS = 3_000  # bound on the sampled rows of each class
COST, EPOCHS = 1.0, 12
BLOCK = 2 << 20


def _hashed(codes: np.ndarray, salt: int) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - BITS)).astype(np.uint64)


def _shapes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A shape code for each word and the text it is in. Words are parted by ASCII white space;
    a shape holds the length, the kinds of the first and last byte, and whether the word is the
    one before it again."""
    parts = pc.ascii_split_whitespace(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    words = parts.flatten().cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    sizes = np.diff(at)
    full = np.flatnonzero(sizes)
    at, owner, sizes = at[:-1][full], owner[full], sizes[full]
    if not len(full):
        return np.zeros(0, np.int64), owner
    data = np.frombuffer(words.buffers()[2], np.uint8)
    kinds = np.zeros(256, np.int64)
    for i, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                 b"0123456789", b".,;:", b"!?", b"|", b"#$%&*")):
        kinds[list(members)] = i + 1
    coded = words.dictionary_encode().indices.to_numpy()[full]
    same = np.r_[False, (coded[1:] == coded[:-1]) & (owner[1:] == owner[:-1])]
    length = np.minimum(sizes, 15)
    middle = kinds[data[at + sizes // 2]]
    shape = ((length * 8 + kinds[data[at]]) * 8 + middle) * 8 + kinds[data[at + sizes - 1]]
    return shape * 2 + same, owner


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text: text numbers in order, and feature numbers."""
    raw = texts.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    keys = []
    if at[-1] > at[0]:
        data = np.frombuffer(raw.buffers()[2], np.uint8)[at[0]:at[-1]].astype(np.uint32)
        grams = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        owner = np.repeat(np.arange(len(raw), dtype=np.uint64), np.diff(at))[:len(grams)]
        inside = np.ones(len(grams), bool)
        ends = (at[1:] - at[0])
        for k in (1, 2):  # grams that would reach into the next text
            cut = ends - k
            inside[cut[(cut >= 0) & (cut < len(grams))]] = False
        keys.append((owner << np.uint64(BITS) | _hashed(grams, 1))[inside])
    shape, owner = _shapes(texts)
    if len(shape):
        keys.append(owner.astype(np.uint64) << np.uint64(BITS) | _hashed(shape, 2))
        pair = owner[1:] == owner[:-1]
        both = (shape[:-1] << 20 | shape[1:])[pair]
        keys.append(owner[1:][pair].astype(np.uint64) << np.uint64(BITS) | _hashed(both, 3))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.sort(np.concatenate(keys))
    key = key[np.r_[True, key[1:] != key[:-1]]]
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray,
                            cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights of the L1-loss SVM over rows of unit length with entries ``ratio`` at their
    features. ``y`` holds -1 and 1; the classes weigh the same."""
    rng, w = np.random.default_rng(seed), np.zeros(len(ratio))
    values = []
    for f in rows:
        v = ratio[f]
        n = np.sqrt((v * v).sum())
        values.append(v / n if n else v)
    alpha = np.zeros(len(rows))
    most = cost * len(y) / 2 / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, v = rows[i], values[i]
            if not len(f):
                continue
            gradient = y[i] * (w[f] @ v) - 1  # the diagonal is 1
            new = min(max(alpha[i] - gradient, 0.0), most[i])
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return w


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with the smoothed targets of Platt."""
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, theta = np.stack([margin, np.ones_like(margin)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        theta -= np.linalg.solve(h, x.T @ (p - target))
    return float(theta[0]), float(theta[1])


def fit_quality(labelled: DataFrame, text_col: str = "text", label_col: str = "quality",
                id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> dict:
    """A model from rows of text and label 0 or 1; rows with other labels are left out."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"),
                           F.col(label_col).cast("int").alias("label"),
                           F.xxhash64(F.col(id_col), F.col(text_col)).alias("pick"))
    rows = rows.filter(F.col("label").isin(0, 1))
    n = {r["label"]: r["n"] for r in labelled.filter(F.col(label_col).isin(0, 1)).groupBy(
        F.col(label_col).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        share = n.get(1, 0) / sum(n.values()) if n else 0.5
        return {"share": share}
    share = {k: min(1.0, fit_rows / v) for k, v in n.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                owner, feature = features(text_column(block, "text"))
                label = block.column("label").to_numpy()
                u = (block.column("pick").to_numpy() & ((1 << 30) - 1)) / (1 << 30)
                for k in (0, 1):
                    seen[k] += np.bincount(feature[label[owner] == k], minlength=1 << BITS)
                chosen = np.flatnonzero(u < np.where(label == 1, share[1], share[0]))
                ends = np.searchsorted(owner, np.arange(block.num_rows + 1))
                if len(chosen):
                    none = pa.nulls(len(chosen), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [none, none, none, block.column("label").take(pa.array(chosen)),
                         block.column("pick").take(pa.array(chosen)),
                         pa.array([feature[ends[i]:ends[i + 1]].astype(np.int32).tobytes() for i in chosen],
                                  pa.binary())],
                        names=["feature", "low", "high", "label", "pick", "held"])
        some = np.flatnonzero(seen.any(0))
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(seen[0, some]), pa.array(seen[1, some]),
                 pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.int64()),
                 pa.nulls(len(some), pa.binary())],
                names=["feature", "low", "high", "label", "pick", "held"])

    # One pass gives both: counts of all rows, and the features of the sampled ones.
    passed = written(rows.mapInArrow(
        count, "feature bigint, low bigint, high bigint, label int, pick bigint, held binary"), "quality")
    counts = passed.filter("feature IS NOT NULL").groupBy("feature").agg(
        F.sum("low").alias("low"), F.sum("high").alias("high"))

    def fit(key, counted: pa.Table, sample: pa.Table) -> pa.Table:
        p, q = np.ones(1 << BITS), np.ones(1 << BITS)
        f = counted["feature"].to_numpy()
        p[f] += counted["high"].to_numpy()
        q[f] += counted["low"].to_numpy()
        ratio = np.log(p / p.sum()) - np.log(q / q.sum())
        sample = sample.sort_by([("pick", "ascending"), ("label", "ascending")])
        held = [np.frombuffer(b, np.int32) for b in sample["held"].to_pylist()]
        label = sample["label"].to_numpy()
        w = dual_coordinate_descent(held, ratio, np.where(label == 1, 1.0, -1.0))
        norm = [np.sqrt((ratio[h] ** 2).sum()) or 1.0 for h in held]
        margin = np.array([(w[h] * ratio[h]).sum() / n for h, n in zip(held, norm)])
        slope, shift = _calibrate(margin, label.astype(float))
        return pa.table({"ratio": [ratio.astype(np.float32).tobytes()], "slope": [slope],
                         "weight": [(w * ratio).astype(np.float32).tobytes()], "shift": [shift]},
                        pa.schema([("ratio", pa.binary()), ("slope", pa.float64()),
                                   ("weight", pa.binary()), ("shift", pa.float64())]))

    # Both sides are bounded: one row per dimension, and the sample.
    model = counts.withColumn("all", F.lit(0)).groupBy("all").cogroup(
        passed.filter("held IS NOT NULL").select("label", "pick", "held").withColumn("all", F.lit(0))
        .groupBy("all")).applyInArrow(fit, "ratio binary, slope double, weight binary, shift double")
    return model.collect()[0].asDict()


def score_quality(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` double added (a column of this name is replaced)."""
    docs = docs.drop("score")
    if "share" in model:
        return docs.withColumn("score", F.lit(float(model["share"])))
    packed = docs.sparkSession.sparkContext.broadcast(
        {k: bytes(v) if isinstance(v, (bytes, bytearray)) else v for k, v in model.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = packed.value
        weight = np.frombuffer(m["weight"], np.float32).astype(float)
        square = np.frombuffer(m["ratio"], np.float32).astype(float) ** 2
        for batch in batches:
            for block in blocks(batch, text_col, BLOCK):
                owner, feature = features(text_column(block, text_col))
                dot = np.bincount(owner, weight[feature], block.num_rows)
                norm = np.sqrt(np.bincount(owner, square[feature], block.num_rows))
                margin = dot / np.where(norm > 0, norm, 1)
                score = 1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["shift"], -700, 700)))
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(score)],
                                                 names=[*block.schema.names, "score"])

    return docs.mapInArrow(run, with_fields(docs, "score double"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    known = crc32_rest("doc_id", 3) != 1
    # Labels grow with the documents, so the two meet by a shuffle at every size.
    labels = labels.filter(known & F.col("quality").isNotNull()).hint("merge")
    labelled = docs.filter(known).join(labels, "doc_id")
    scored = score_quality(docs, fit_quality(labelled))
    return scored.select("doc_id", (crc32_rest("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
