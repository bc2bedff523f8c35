"""Line deduplication across documents by a deletion-neighbourhood join.

A line is dropped if an earlier line, by (id, hash of the text, line number), has the same words
or, for lines of ``min_words`` or more, differs from it by at most one word put in, left out or
exchanged. Words are parted by ASCII white space, with A-Z lower-cased.

Two lines within that bound share a variant: a line with one word left out, or the whole line.
All variants are emitted as hashed keys and joined on equality; from each key only the earliest
line is taken, so no pairs within a group are formed, and what is found is verified word by word.
Before that, lines without a partner that shares their first or second half are set aside: one
edit leaves one of the two halves as it is.

Lines without words are kept. A null text stays null. Rows with equal id and text are one
document: they keep and lose the same lines. Null ids come first. A document that loses every
line with words stays, with what is left of its text. Other columns are passed through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.skew import attach_by_key
from .shared import set_aside, written
from .text import blocks, hash_words, mixed, split_words, text_column

MIN_WORDS = 8
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLOCK = 1 << 20
BROADCAST_LINES = 1_000_000
POS = ["id", "fp", "line_no"]


def _key(x: np.ndarray) -> np.ndarray:
    return mixed(x).view(np.int64)


class LineHashes:
    """Hashes of word ranges of lines, from sums of word hash times a power of ``BASE``."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray, pa.Array], seed: int = 0):
        codes, self.offsets, vocabulary = words
        hashes = hash_words(vocabulary, seed)[codes] if len(codes) else np.zeros(0, np.uint64)
        n = len(codes)
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, INVERSE, np.uint64)], dtype=np.uint64)
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(hashes * up[:n], dtype=np.uint64)]
        self.words = np.diff(self.offsets)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A key of the words from ``begin`` to ``end``, the same wherever they stand."""
        return _key((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))

    def without_each(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, key) of every line with the word at that place left out."""
        line = np.repeat(np.arange(len(self.words)), self.words)
        at = np.arange(len(line))
        begin, end = self.offsets[:-1][line], self.offsets[1:][line]
        left = (self.sums[at] - self.sums[begin]) + (self.sums[end] - self.sums[at + 1]) * INVERSE
        return line, at - begin, _key(left * self.down[begin] + (self.words[line] - 1).astype(np.uint64))

    def halves(self) -> list[np.ndarray]:
        """Four keys a line: its first and last words as one of a pair whose longer line has as
        many words as it has, and as one of a pair whose longer line has one more.

        Of n words in the longer line, the first m = (n - 1) // 2 are the same in both lines if
        the edit is at place m or later, else the last n - 1 - m are."""
        begin, end, n = self.offsets[:-1], self.offsets[1:], self.words
        keys = []
        for longest in (n, n + 1):
            half = np.minimum((longest - 1) // 2, n)
            tail = np.clip(longest - 1 - half, 0, n)
            salt = longest.astype(np.uint64) * np.uint64(2)
            for part, key in ((0, self.of(begin, begin + half)), (1, self.of(end - tail, end))):
                keys.append(_key(key.view(np.uint64) + _key(salt + np.uint64(part)).view(np.uint64)))
        return keys


def _lines(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of each line in the block, and the lines."""
    parts = pc.split_pattern(text_column(block, "text"), "\n")
    counts = np.diff(parts.offsets.to_numpy())
    owner = np.repeat(np.arange(block.num_rows), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts), parts.flatten()


def _hash_lines(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                owner, number, lines = _lines(block)
                words = split_words(lines)
                hashes, again = LineHashes(words), LineHashes(words, seed=1)
                kept = np.flatnonzero(hashes.words > 0)
                full = [h.of(h.offsets[:-1], h.offsets[1:])[kept] for h in (hashes, again)]
                long = hashes.words[kept] >= min_words
                halves = np.stack(hashes.halves(), 1)[kept]
                keys = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(4 * long)].astype(np.int32)), pa.array(halves[long].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [block.column("id").take(pa.array(owner[kept])),
                     block.column("fp").take(pa.array(owner[kept])),
                     pa.array(number[kept].astype(np.int32)), pa.array(full[0]), pa.array(full[1]), keys],
                    names=[*POS, "f", "g", "halves"])
    return run


def _emit_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, fp, line_no, place, key, line) of the variants of the wanted lines; place -1 is the
    whole line, which comes with its text."""
    for batch in batches:
        for block in blocks(batch, "text", BLOCK):
            owner, number, lines = _lines(block)
            wanted = block.column("wanted")
            pairs = wanted.flatten().to_numpy()
            rows = np.repeat(np.arange(block.num_rows), np.diff(wanted.offsets.to_numpy()))
            first = np.searchsorted(owner, np.arange(block.num_rows))
            chosen = np.sort(first[rows] + pairs)
            owner, number = owner[chosen], number[chosen]
            texts = lines.take(pa.array(chosen))
            hashes = LineHashes(split_words(texts))
            line, place, key = hashes.without_each()
            line = np.r_[np.arange(len(chosen)), line]
            place = np.r_[np.full(len(chosen), -1), place]
            key = np.r_[hashes.of(hashes.offsets[:-1], hashes.offsets[1:]), key]
            yield pa.RecordBatch.from_arrays(
                [block.column("id").take(pa.array(owner[line])), block.column("fp").take(pa.array(owner[line])),
                 pa.array(number[line].astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(key),
                 pa.concat_arrays([texts, pa.nulls(len(line) - len(texts), pa.large_string())])],
                names=[*POS, "place", "key", "line"])


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word put in, left out or exchanged at most makes one list the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    least, same = min(len(a), len(b)), 0
    while same < least and a[same] == b[same]:
        same += 1
    tail = 0
    while tail < least - same and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return max(len(a), len(b)) - same - tail <= 1


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(
            batch.column(c).cast(pa.large_string())))).to_pylist() for c in ("line", "against")]
        good = pa.array([within_one(a, b) for a, b in zip(*lists)], pa.bool_())
        yield batch.select(POS).filter(good)


def _sized(df: DataFrame, lines: int) -> DataFrame:
    """Broadcast while it lists few lines; beyond that, the documents are shuffled to it."""
    return F.broadcast(df) if lines <= BROADCAST_LINES else df


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS) -> DataFrame:
    """(id, fp, line_no) of the lines to drop; ``fp`` is a hash of the text, lines count from 0."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("fp"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    place = F.struct(*POS)
    lines = written(rows.mapInArrow(_hash_lines(min_words), f"id {kind}, fp bigint, line_no int, "
                                    "f bigint, g bigint, halves array<bigint>"), "lines")

    # Lines with the same words: all but the earliest go.
    firsts = written(lines.groupBy("f", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")),
                     "first-lines")
    copies = attach_by_key(lines.select(*POS, "f", "g"), firsts.filter("copies > 1"), ["f", "g"], "copies")
    exact = copies.filter(F.struct(*POS) > F.col("first")).select(*POS)

    # Of the others, those that share half of their words with another line.
    half = lines.filter(F.size("halves") > 0).select("f", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.min("f").alias("low"), F.max("f").alias("high")).filter("low < high")
    partnered = half.join(shared, "half", "left_semi").select("f").distinct()
    wanted = firsts.join(partnered, "f", "left_semi").select("first.*")
    per_doc = wanted.groupBy("id", "fp").agg(F.sort_array(F.collect_set("line_no")).alias("wanted"))
    per_doc = written(per_doc.select(F.col("id").alias("_id"), F.col("fp").alias("_fp"), "wanted"), "wanted-lines")
    per_doc = _sized(per_doc, per_doc.agg(F.sum(F.size("wanted"))).first()[0] or 0)
    texts = rows.join(per_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
    texts = texts.select("id", "fp", "text", "wanted")

    variants = written(texts.mapInArrow(
        _emit_variants, f"id {kind}, fp bigint, line_no int, place int, key bigint, line string"),
        "line-variants").withColumn("pos", place)
    text = variants.filter("place < 0").select("pos", "line")
    # Most variants have no partner; only those with one go on.
    twice = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    variants = written(variants.select("key", "place", "pos").join(twice, "key", "left_semi"), "shared-variants")
    by_place = variants.groupBy("key", "place").agg(F.min("pos").alias("least"))
    by_key = by_place.groupBy("key").agg(
        F.min(F.when(F.col("place") < 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.col("least"))).alias("cut"))
    both = by_place.join(by_key, "key").select("key", "place", F.array_min(F.array_compact(
        F.when(F.col("place") < 0, F.array("least", "cut")).otherwise(F.array("least", "whole")))).alias("other"))
    found = written(variants.join(both, ["key", "place"]).filter(F.col("other") < F.col("pos"))
                    .select("pos", "other").distinct(), "line-pairs")
    pairs = found.join(text, "pos").join(text.select(F.col("pos").alias("other"), F.col("line").alias("against")),
                                         "other")
    near = pairs.select("pos.*", "line", "against").mapInArrow(_verify, f"id {kind}, fp bigint, line_no int")
    return exact.unionByName(near).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without duplicate lines, and ``n_dropped``, how many each lost (a column of this
    name is replaced)."""
    docs, named = set_aside(docs.drop("n_dropped"), [id_col, text_col])
    drop = duplicate_lines(docs, id_col, text_col, min_words).groupBy("id", "fp").agg(
        F.collect_set("line_no").alias("__drop"))
    drop = drop.select(F.col("id").alias("__id"), F.col("fp").alias("__fp"), "__drop")
    joined = docs.join(drop, F.col(id_col).eqNullSafe(F.col("__id")) & (
        F.xxhash64(F.col(text_col)) == F.col("__fp")), "left")
    joined = joined.withColumn("n_dropped", F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint"))
    joined = joined.drop("__id", "__fp")

    at = joined.columns.index(text_col)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column("__drop").to_pylist()
            texts = batch.column(at).to_pylist()
            for i, drop in enumerate(drops):
                if drop:
                    gone = set(drop)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[text_col] = pa.array(texts, batch.schema.field(at).type)
            del columns["__drop"]
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return named(joined.mapInArrow(strip, joined.drop("__drop").schema))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
