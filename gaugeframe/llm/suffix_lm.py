"""Language-model scoring with a probabilistic suffix tree over bytes.

The text with A-Z lower-cased, as UTF-8 bytes with an end symbol, is predicted byte by byte.
States are contexts of 0 to ``DEPTH`` bytes. A context is a candidate if it was seen ``LEAST``
times in training, so the tree grows with the corpus. Candidates of up to ``SHORT`` bytes are
retained; a longer one is if its next-symbol distribution diverges from that of its suffix (count
times Kullback-Leibler divergence of at least ``GAIN`` nats), or if a longer retained context ends
with it. A state's distribution is smoothed with that of the next shorter state, by the number of
different symbols seen (Witten-Bell); each byte is scored by the longest retained suffix of what
comes before it.

No task holds the tree. Bounded chunks of documents are listed as their distinct codes (context
and symbol) with training counts, and these lists are cut into ranges of the last ``SHORT`` + 1
bytes of context. Contexts that end alike fall in one range, so each range grows its part of the
tree, from the counts of all chunks, and looks up the codes of each chunk there. What is sent and
answered are a chunk's distinct codes and words, which grow far less than its text: so chunks are
large, and a task works on one in pieces, holding no more than the distinct ones and a piece.

Beside it stands the base: add-one unigram probabilities of words ``[^\\x20\\x09-\\x0D]+`` and an
end token. Word counts are joined to the words of the same chunks, so that a task holds the
counts of its own words only.

A null text is empty and has the end symbol alone. Rows with equal ids are scored each for
itself. Without training rows every probability is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .language_id import crc32_rest
from .shared import written
from .text import blocks, split_words, text_column

DEPTH = 6
SHORT = 2
LEAST = 20
GAIN = 8.0
SYMBOLS = 257  # 256 byte values and the end
EDGE = 0xFF  # never in UTF-8: the end symbol, and what stands before a text
CHUNK_BYTES = 24 << 20
PIECE = 4 << 20  # text of a chunk that is listed or split at once
BLOCK = 2 << 20
RANGE_CODES = 1 << 20  # codes of all chunks in a range, about
SAMPLES = 256  # codes of a chunk that place the ranges


def codes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text (its bytes and the end): ``DEPTH`` bytes of context, the
    latest highest, and the symbol, lowest, as one number; and how many symbols each text has.
    In the order of these numbers, contexts that end alike stand together at every length."""
    raw = pc.ascii_lower(texts).cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    sizes = np.diff(at)
    data = np.frombuffer(raw.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    # Each text stands after DEPTH edge symbols and before one.
    begin = np.cumsum(sizes + DEPTH + 1) - (sizes + 1)
    held = np.full(int((sizes + DEPTH + 1).sum()) if len(sizes) else 0, EDGE, np.uint8)
    shift = np.repeat(begin - (at[:-1] - at[0]), sizes)
    held[np.arange(len(data)) + shift] = data
    starts = np.zeros(len(held), bool)
    first = begin - DEPTH
    for k in range(DEPTH):
        starts[first + k] = True
    wide = held.astype(np.uint64)
    code = wide.copy()
    for k in range(1, DEPTH + 1):
        code[k:] |= wide[:-k] << np.uint64(8 * (DEPTH + 1 - k))
    return code[~starts], sizes + 1


def pack(numbers: np.ndarray) -> bytes:
    """8-byte numbers, compressed byte place by byte place."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes, kind) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).reshape(-1)


def distinct_codes(texts: pa.Array, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of texts, in order, and how often each is in those learned from."""
    marked = []
    for block in blocks(pa.RecordBatch.from_arrays([texts, pa.array(learned)], names=["text", "learned"]),
                        "text", BLOCK):
        codes, sizes = codes_of(text_column(block, "text"))
        flags = np.repeat(block.column("learned").to_numpy(zero_copy_only=False), sizes)
        marked.append(codes << np.uint64(1) | flags.astype(np.uint64))
    marked = np.sort(np.concatenate(marked) if marked else np.zeros(0, np.uint64))
    codes = marked >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, int)
    n = np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return codes[first], n


def pieces_of(table: pa.Table, limit: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows of a chunk with about ``limit`` bytes of text, and that text."""
    for batch in table.to_batches():
        for piece in blocks(batch, "text", limit):
            yield piece, text_column(piece, "text")


def added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, int)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def shorter(codes: np.ndarray) -> np.ndarray:
    """Codes without the earliest byte: the lowest of the context, above the symbol."""
    return codes >> np.uint64(16) << np.uint64(8) | codes & np.uint64(0xFF)


class SuffixTree:
    """Counts of the retained contexts by depth: sorted codes of context and next symbol with
    their counts, and sorted contexts with their totals and numbers of different symbols."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.codes = [c for c, _ in levels]
        self.counts = [n for _, n in levels]
        self.contexts, self.totals, self.kinds = [], [], []
        for c, n in levels:
            context = c >> np.uint64(8)
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(c) else np.zeros(0, int)
            self.contexts.append(context[first])
            self.totals.append(np.add.reduceat(n, first) if len(first) else n[:0])
            self.kinds.append(np.diff(np.r_[first, len(c)]))

    def log10_probs(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1 / SYMBOLS)
        alive = np.arange(len(codes))  # those whose context of this depth is retained
        for k in range(DEPTH + 1):
            if not len(self.codes[k]) or not len(alive):
                break
            context = codes[alive] >> np.uint64(8 * (DEPTH + 1 - k))
            code = context << np.uint64(8) | codes[alive] & np.uint64(0xFF)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == context
            alive, at, code = alive[known], at[known], code[known]
            i = np.minimum(np.searchsorted(self.codes[k], code), len(self.codes[k]) - 1)
            seen = np.where(self.codes[k][i] == code, self.counts[k][i], 0)
            kinds = self.kinds[k][at]
            p[alive] = (seen + kinds * p[alive]) / (self.totals[k][at] + kinds)
        return np.log10(p)


def score_block(texts: pa.Array, listed: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """log10 probability of each text, from the log10 probabilities of the listed codes."""
    codes, sizes = codes_of(texts)
    if not len(sizes):
        return np.zeros(0)
    order = np.argsort(codes)  # equal contexts are looked up once
    ordered = codes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    each = np.empty(len(codes))
    each[order] = np.repeat(logs[np.searchsorted(listed, ordered[first])], np.diff(np.r_[first, len(codes)]))
    return np.add.reduceat(each, np.cumsum(sizes) - sizes)


def grow(deepest: tuple[np.ndarray, np.ndarray], short: list[tuple[np.ndarray, np.ndarray]],
         least: int, gain: float) -> SuffixTree:
    """The tree of one range: from the counts of its codes, and those of all codes of up to
    ``SHORT`` bytes that end in it."""
    levels = {DEPTH: deepest, **dict(enumerate(short))}
    for k in range(DEPTH - 1, SHORT, -1):
        levels[k] = added(shorter(levels[k + 1][0]), levels[k + 1][1])
    out, below = [], np.zeros(0, np.uint64)  # contexts that a retained longer one ends with
    for k in range(DEPTH, -1, -1):
        codes, n = levels[k]
        whole = SuffixTree([(codes, n)])
        contexts, totals = whole.contexts[0], whole.totals[0]
        at = np.searchsorted(contexts, codes >> np.uint64(8))
        if k > SHORT and len(codes):
            parent = SuffixTree([levels[k - 1]])
            short_code = shorter(codes)
            short_n = parent.counts[0][np.searchsorted(parent.codes[0], short_code)]
            short_total = parent.totals[0][np.searchsorted(parent.contexts[0], short_code >> np.uint64(8))]
            ratio = np.log(n / totals[at] / (short_n / short_total))
            kept = (totals >= least) & ((np.bincount(at, n * ratio, len(contexts)) >= gain) | np.isin(contexts, below))
            below = np.unique(contexts[kept] >> np.uint64(8))
        else:
            kept = (totals >= least) | (k == 0)
        out.append((codes[kept[at]], n[kept[at]]))
    return SuffixTree(out[::-1])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last SHORT + 1 bytes of context of evenly spaced codes of each chunk."""
    for batch in batches:
        for packed in batch.column("codes"):
            codes = unpack(packed.as_py(), np.uint64)
            at = np.linspace(0, len(codes) - 1, min(SAMPLES, len(codes))).astype(int)
            yield pa.RecordBatch.from_arrays([pa.array(_endings(codes[at]))], names=["ending"])


def _endings(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(8 * (DEPTH - SHORT))).astype(np.int64)


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of the codes of ``SHORT`` bytes that were learned, per chunk."""
    for batch in batches:
        for packed, counted in zip(batch.column("codes"), batch.column("seen")):
            codes, n = unpack(packed.as_py(), np.uint64), unpack(counted.as_py(), np.int64)
            codes, n = codes[n > 0], n[n > 0]
            head = codes >> np.uint64(8 * (DEPTH + 1 - SHORT)) << np.uint64(8)
            codes, n = added(head | codes & np.uint64(0xFF), n)
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n)], names=["code", "n"])


def _ranges(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(part, chunk, codes, seen): the codes of each chunk cut into ranges; and (part, level,
    code, n): the learned codes of up to ``SHORT`` bytes that end in each range."""
    total = parts.agg(F.sum("m")).first()[0] or 0
    count = -(-total // RANGE_CODES)
    bounds = np.zeros(0, np.int64)
    if count > 1:
        ends = parts.select("codes").mapInArrow(_sampled, "ending bigint").agg(F.percentile_approx(
            "ending", [i / count for i in range(1, count)], 10 * max(1000, count))).first()[0]
        bounds = np.unique(ends)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed, counted in zip(*[batch.column(c) for c in ("chunk", "codes", "seen")]):
                codes, n = unpack(packed.as_py(), np.uint64), unpack(counted.as_py(), np.int64)
                at = np.r_[0, np.searchsorted(_endings(codes), bounds, "right"), len(codes)]
                used = np.flatnonzero(at[1:] > at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), chunk.as_py()), pa.int64()),
                     *[pa.array([pack(x[at[i]:at[i + 1]]) for i in used], pa.binary()) for x in (codes, n)]],
                    names=["part", "chunk", "codes", "seen"])

    short = written(parts.select("codes", "seen").mapInArrow(_short_counts, "code bigint, n bigint")
                    .groupBy("code").agg(F.sum("n").alias("n")), "short-contexts")
    levels = short.withColumn("level", F.lit(SHORT))
    for k in range(SHORT - 1, -1, -1):
        context = F.shiftright("code", 8 * (SHORT + 1 - k))
        levels = levels.unionByName(short.groupBy(F.shiftleft(context, 8).bitwiseOR(
            F.col("code").bitwiseAND(F.lit(0xFF))).alias("code")).agg(F.sum("n").alias("n")).withColumn("level", F.lit(k)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, context = batch.column("level").to_numpy(), batch.column("code").to_numpy() >> 8
            wide = 8 * (SHORT + 1 - level)
            ends = [np.searchsorted(bounds, e, "right") for e in (context << wide, ((context + 1) << wide) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1]), *batch.columns],
                                             names=["low", "high", *batch.schema.names])

    placed = levels.select("level", "code", "n").mapInArrow(
        place, "low bigint, high bigint, level int, code bigint, n bigint")
    placed = placed.select(F.explode(F.sequence("low", "high")).alias("part"), "level", "code", "n")
    return parts.select("chunk", "codes", "seen").mapInArrow(
        cut, "part bigint, chunk bigint, codes binary, seen binary"), placed


def _grown(lists: pa.Table, short: pa.Table, least: int, gain: float) -> tuple[SuffixTree, list[np.ndarray], np.ndarray]:
    """The tree of a range, the codes of each chunk in it, and all of its codes."""
    codes = [unpack(x.as_py(), np.uint64) for x in lists["codes"]]
    seen = [unpack(x.as_py(), np.int64) for x in lists["seen"]]
    known, n = added(np.concatenate(codes), np.concatenate(seen))
    level, code, count = [short[c].to_numpy() for c in ("level", "code", "n")]
    above = [added(code[level == k].astype(np.uint64), count[level == k]) for k in range(SHORT + 1)]
    return grow((known[n > 0], n[n > 0]), above, least, gain), codes, known


def _listed(dealt: DataFrame) -> DataFrame:
    """(chunk, m, codes, seen, words, counts) per chunk of (chunk, train, text): its distinct codes,
    how many, and its words, both with their counts in what is learned from."""
    def gather(table: pa.Table) -> pa.Table:
        found, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        vocabulary, n = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        for piece, text in pieces_of(table, PIECE):
            learned = piece.column("train").to_numpy(zero_copy_only=False)
            codes, offsets, words = split_words(text)
            owned = np.repeat(learned, np.diff(offsets))
            counts = np.bincount(codes[owned], minlength=len(words)).astype(np.int64)
            merged = pa.concat_arrays([vocabulary, words.cast(pa.large_string())]).dictionary_encode()
            vocabulary, at = merged.dictionary, merged.indices.to_numpy()
            n = np.bincount(at, np.r_[n, counts], len(vocabulary)).astype(np.int64)
            listed = distinct_codes(text, learned)
            found, seen = added(np.r_[found, listed[0]], np.r_[seen, listed[1]])
        order = pc.sort_indices(vocabulary)  # words that begin alike take less space together
        vocabulary, n = vocabulary.take(order), n[order.to_numpy()]
        return pa.table({"chunk": table["chunk"][:1], "m": pa.array([len(found)], pa.int64()),
                         "codes": pa.array([pack(found)], pa.binary()), "seen": pa.array([pack(seen)], pa.binary()),
                         "words": pa.array([vocabulary.cast(pa.string())], pa.list_(pa.string())),
                         "counts": pa.array([n], pa.list_(pa.int64()))})

    return written(dealt.groupBy("chunk").applyInArrow(
        gather, "chunk bigint, m bigint, codes binary, seen binary, words array<string>, counts array<bigint>"), "chunks", "zstd")


def fit_suffix_tree(texts: DataFrame, p_min: float | None = None, gain: float = GAIN,
                    least: int = LEAST) -> SuffixTree:
    """The whole tree from all texts of a DataFrame with the column ``text``, for small corpora or
    with a share ``p_min`` of all symbols as the least count, where it has at most 1 / p_min
    contexts of each length."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = _listed(texts.select(F.pmod(F.xxhash64(text), F.lit(8)).alias("chunk"), F.lit(True).alias("train"),
                                 text.alias("text")))
    lists, short = _ranges(parts)
    if p_min is not None:
        least = max(1, math.ceil(p_min * (short.filter("level = 0 AND part = 0").agg(F.sum("n")).first()[0] or 0)))

    def retained(key, lists: pa.Table, short: pa.Table) -> pa.Table:
        if not lists.num_rows:
            levels = []
        else:
            tree = _grown(lists, short, least, gain)[0]
            levels = list(enumerate(zip(tree.codes, tree.counts)))
        return pa.table({"level": pa.array(np.concatenate([np.zeros(0, int), *[np.full(len(c), k) for k, (c, _) in levels]]), pa.int64()),
                         "code": pa.array(np.concatenate([np.zeros(0, np.int64), *[c.astype(np.int64) for _, (c, _) in levels]])),
                         "n": pa.array(np.concatenate([np.zeros(0, np.int64), *[n for _, (_, n) in levels]]), pa.int64())})

    table = lists.groupBy("part").cogroup(short.groupBy("part")).applyInArrow(
        retained, "level bigint, code bigint, n bigint").distinct().orderBy("code").toArrow()
    level, code, n = [table[c].to_numpy() for c in ("level", "code", "n")]
    return SuffixTree([(code[level == k].astype(np.uint64), n[level == k]) for k in range(DEPTH + 1)])


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                least: int = LEAST, gain: float = GAIN, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs``: its id, ``train`` as given, n_tokens, n_known, train_tokens,
    base_score and score. The rows where ``train`` is true are learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint")).alias("bytes"),
                    F.count_if("train").alias("ends")).first()
    chunks = max(1, -(-(size["bytes"] or 0) // chunk_bytes))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    parts = _listed(dealt.select("chunk", "train", "text"))

    held = parts.select("chunk", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
    counts = written(held.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = size["ends"] or 0
    tokens = (whole["n"] or 0) + ends
    distinct = whole["v"] + (1 if ends else 0)
    per_chunk = held.select("chunk", "word").join(counts, "word").select("chunk", "word", "c")

    def look_up(key, lists: pa.Table, short: pa.Table) -> pa.Table:
        if not lists.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "part": pa.array([], pa.int64()),
                             "codes": pa.array([], pa.binary()), "logs": pa.array([], pa.binary())})
        tree, codes, known = _grown(lists, short, least, gain)
        logs = tree.log10_probs(known)
        return pa.table({"chunk": lists["chunk"], "part": lists["part"], "codes": lists["codes"], "logs": pa.array(
            [pack(logs[np.searchsorted(known, c)]) for c in codes], pa.binary())})

    lists, short = _ranges(parts)
    logs = lists.groupBy("part").cogroup(short.groupBy("part")).applyInArrow(
        look_up, "chunk bigint, part bigint, codes binary, logs binary")
    answers = logs.unionByName(per_chunk, allowMissingColumns=True)

    def score(key, table: pa.Table, known: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in fields.items()})
        words = known.filter(pc.is_null(known["part"]))
        known_words, known_counts = words["word"].cast(pa.large_string()), np.r_[words["c"].to_numpy(), 0]
        # The ranges in order have the chunk's distinct codes in order.
        found = known.filter(pc.is_valid(known["part"])).sort_by("part")
        listed = np.concatenate([unpack(x.as_py(), np.uint64) for x in found["codes"]])
        logs = np.concatenate([unpack(x.as_py(), np.float64) for x in found["logs"]])
        out = []
        for piece, text in pieces_of(table, PIECE):
            codes, offsets, vocabulary = split_words(text)
            at = pc.fill_null(pc.index_in(vocabulary, value_set=known_words), -1)
            c = known_counts[at.to_numpy()]
            n_tokens = np.diff(offsets) + 1
            owner = np.repeat(np.arange(len(n_tokens)), n_tokens - 1)
            n_known = np.bincount(owner, (c > 0)[codes], len(n_tokens)).astype(np.int64) + (1 if ends else 0)
            base = np.bincount(owner, np.log10(c + 1.0)[codes], len(n_tokens)) + math.log10(ends + 1) - n_tokens * math.log10(tokens + distinct + 1)
            scores = np.concatenate([score_block(text_column(b, "text"), listed, logs) for b in blocks(piece, "text", BLOCK)])
            out.append(pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("train"), pa.array(n_tokens), pa.array(n_known),
                 pa.array(np.full(len(n_tokens), tokens)), pa.array(base), pa.array(scores)], names=list(fields)))
        return pa.Table.from_batches(out)

    fields = {"id": pa.null(), "train": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
              "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"id {kind}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double")
    return scored.withColumnRenamed("id", id_col)


def op9_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_texts(docs, crc32_rest("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")
