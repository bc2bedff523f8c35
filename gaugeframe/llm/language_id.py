"""Language identification by a byte-level convolutional network.

Filters of several widths slide over byte embeddings of a fixed-length window; the maximum of
each filter over the window feeds a softmax. The network is trained in numpy, in one task, on
windows of a bounded sample of labelled rows. A text is cut into consecutive windows, all of
them are scored, and their log-probabilities are averaged by the bytes they hold.

A text that is null or has no letter is ``und`` with score 0. Rows with equal ids are scored
each for itself. An empty table gives an empty result; without any label, all is ``und``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import blocks, text_column, with_fields

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBED = 8
FIT_ROWS = 2_000  # bound on the labelled rows of each language that the network is fitted on
FIT_WINDOWS = 8  # windows, evenly spaced, that one such row gives
STEPS, BATCH, RATE = 700, 64, 0.01
REACH = max(WIDTHS)
BLOCK = 64 << 10  # bytes of windows that are scored at once
READ = 512 << 10


def crc32_rest(id_col: str, mod: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod


def windows_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-padded windows of all texts, the text of each, and the bytes each holds."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    sizes = np.diff(at)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = at[:-1][owner] + nth * WINDOW
    held = np.minimum(WINDOW, at[1:][owner] - begin)
    index = begin[:, None] + np.arange(WINDOW)
    out = data[np.minimum(index, max(len(data) - 1, 0))] if len(owner) else np.zeros((0, WINDOW), np.uint8)
    out[np.arange(WINDOW) >= held[:, None]] = 0
    return out, owner, held


class ByteConvNet:
    """Embedding of bytes, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.languages = languages
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        # One matrix for all widths; narrow filters are zero beyond their width.
        self.mask = np.zeros((REACH * EMBED, n), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
        self.filters = rng.normal(0, 0.25, self.mask.shape).astype(np.float32) * self.mask
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def _unrolled(self, windows: np.ndarray) -> np.ndarray:
        x = self.embed[windows]
        n, length = len(windows), WINDOW - REACH + 1
        s = x.strides
        view = np.lib.stride_tricks.as_strided(x, (n, length, REACH * EMBED), (s[0], s[1], s[2]))
        return np.ascontiguousarray(view)

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        n = len(windows)
        cols = self._unrolled(windows).reshape(-1, REACH * EMBED)
        pooled = (cols @ self.filters).reshape(n, -1, len(self.bias)).max(axis=1)
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        names = ["embed", "filters", "bias", "out", "out_bias"]
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        for step in range(1, STEPS + 1):
            y = rng.integers(len(by_label), size=BATCH)  # languages weigh the same
            w = windows[[rng.choice(by_label[k]) for k in y]]
            cols = self._unrolled(w)
            maps = cols @ self.filters
            where = maps.argmax(axis=1)
            pooled = np.take_along_axis(maps, where[:, None], 1)[:, 0] + self.bias
            hidden = np.maximum(pooled, 0)
            z = hidden @ self.out + self.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(BATCH), y] -= 1
            p /= BATCH
            back = (p @ self.out.T) * (pooled > 0)
            picked = cols[np.arange(BATCH)[:, None], where]  # batch, filter, reach * embed
            to_cols = back[:, :, None] * self.filters.T
            embed = np.zeros_like(self.embed)
            held = w[np.arange(BATCH)[:, None, None], where[:, :, None] + np.arange(REACH)]
            np.add.at(embed, held.reshape(-1), to_cols.reshape(-1, EMBED))
            embed[0] = 0
            grads = {"embed": embed, "filters": np.einsum("bf,bfd->df", back, picked) * self.mask,
                     "bias": back.sum(0), "out": hidden.T @ p, "out_bias": p.sum(0)}
            rate = RATE * (1 - step / (STEPS + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                change = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                setattr(self, k, (getattr(self, k) - rate * change).astype(np.float32))


def fit_language_id(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> ByteConvNet | None:
    """A network fitted on at most about ``fit_rows`` rows of each language, picked by a hash of
    id and text. None without labelled text."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang"),
                           F.xxhash64(F.col(id_col), F.col(text_col)).alias("pick"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, fit_rows / counts[k]))])
    u = F.pmod(F.col("pick"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(u < share[F.col("lang")]).select("text", "lang", "pick")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", READ):
                held, owner, _ = windows_of(text_column(block, "text"))
                ends = np.searchsorted(owner, np.arange(block.num_rows + 1))
                keep = np.concatenate([np.unique(np.linspace(a, b - 1, FIT_WINDOWS).astype(int))
                                       for a, b in zip(ends[:-1], ends[1:]) if b > a] or [[]]).astype(int)
                yield pa.RecordBatch.from_arrays(
                    [block.column("lang").take(pa.array(owner[keep])),
                     block.column("pick").take(pa.array(owner[keep])),
                     pa.array([w.tobytes() for w in held[keep]], pa.binary())],
                    names=["lang", "pick", "window"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("pick", "ascending"), ("window", "ascending")])
        held = np.frombuffer(b"".join(table["window"].to_pylist()), np.uint8).reshape(-1, WINDOW)
        labels = np.searchsorted(languages, table["lang"].to_numpy())
        net = ByteConvNet(languages)
        net.fit(held, labels)
        return pa.table({"model": pa.array([pickle.dumps(net.__dict__)], pa.binary())})

    windows = sample.mapInArrow(cut, "lang string, pick bigint, window binary").withColumn("all", F.lit(0))
    # One task gets the bounded sample; the model is a few ten kilobytes.
    model = windows.groupBy("all").applyInArrow(train, "model binary").collect()
    net = ByteConvNet(languages)
    net.__dict__.update(pickle.loads(model[0]["model"]))
    return net


def predict_language(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` string and ``score`` double added; other columns of these
    names are replaced."""
    docs = docs.drop("lang_pred", "score")
    if net is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    model, languages = net.__dict__, net.languages

    def label(texts: pa.Array, nets=[]) -> pa.RecordBatch:
        if not nets:
            nets.append(ByteConvNet(languages))
            nets[0].__dict__.update(model)
        held, owner, sizes = windows_of(texts)
        total = np.zeros((len(texts), len(languages)))
        step = BLOCK // WINDOW
        for a in range(0, len(held), step):
            part = nets[0].log_probs(held[a:a + step]) * sizes[a:a + step, None]
            np.add.at(total, owner[a:a + step], part)
        total /= np.maximum(np.bincount(owner, sizes, len(texts)), 1)[:, None]
        p = np.exp(total - total.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        spoken = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        best = p.argmax(axis=1)
        names = np.where(spoken, np.array(languages, object)[best], "und")
        return pa.array(names, pa.string()), pa.array(np.where(spoken, p.max(axis=1), 0.0))

    schema = with_fields(docs, "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text_col, READ):
                names, scores = label(text_column(block, text_col))
                yield pa.RecordBatch.from_arrays([*block.columns, names, scores],
                                                 names=[*block.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc32_rest("doc_id", 4) == 2)
    net = fit_language_id(docs.filter(~F.col("held_out")))
    return predict_language(docs.drop("lang"), net).drop("text")
