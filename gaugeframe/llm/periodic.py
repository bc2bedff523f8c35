"""Periodic runs of words: stretches that repeat themselves, and texts without the repetitions.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``max(6, 4 * q)`` words long, that no neighbouring word extends. Periods are handled by octaves
P <= q < 2P. In each, a text is cut into overlapping tiles around boundaries P words apart. A run
of the octave has 3P equal pairs at least, so some boundary lies in its first P words, and there
the next 2P words recur q words on: only tiles with such a recurrence are solved, each for itself,
by the Z-functions of the words after the boundary and, backwards, before it. What tiles find are
fragments of runs; those of a text and period are brought together and stitched where they meet.

Texts of more than ``GROUP_WORDS`` words are dealt to tasks by octave and groups of tiles; shorter
ones are tiled where they are read, and only their fragments are shuffled.

Null and empty texts have no words and no run. Rows with equal id and text have the same runs, a row
each; a null id is an id. An empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written
from .text import blocks, mixed, rebased, text_column

#: Texts with more words are dealt out in groups of tiles of about this many words.
GROUP_WORDS = 1 << 18
LEAST_WORDS, LEAST_PERIODS = 6, 4
BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the beginning on."""
    n, z, left, right = len(s), [0] * len(s), 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


_DIVISORS: dict[int, list[int]] = {}


def largest_divisors(q: int) -> list[int]:
    """q by each of its prime factors: a word of q items that repeats a shorter one repeats one
    of these lengths."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return [*out, q // rest] if rest > 1 else out


def solve_tile(codes: np.ndarray, c: int, low: int, high: int, octave: int, periods: list[int]) -> list[tuple]:
    """(period, x, y) at boundary ``c``: words i and i + period are equal for x <= i < y, as far
    as the tile reaches within [low, high). Periods that repeat a shorter one are left out."""
    low, high = max(low, c - octave), min(high, c + 5 * octave)
    after = z_function(codes[c:high].tolist())
    before = codes[low:c][::-1].tolist()
    reach = min(high, c + 2 * octave)
    back = z_function([*before, -1, *codes[low:reach][::-1].tolist()])
    found = []
    for q in periods:
        if after[q] < 2 * octave or any(after[d] >= q - d for d in largest_divisors(q)):
            continue
        ahead = min(back[len(before) + 1 + reach - c - q], len(before))
        found.append((q, c - ahead, c + after[q]))
    return found


def octave_fragments(codes: np.ndarray, sums: np.ndarray, inverse: np.ndarray, octave: int, boundaries: np.ndarray,
                     lows: np.ndarray, highs: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(boundary's index, period, x, y) of every tile with a recurrence of ``2 * octave`` words;
    ``lows`` and ``highs`` are the ends of each boundary's text."""
    window = 2 * octave
    if not len(boundaries) or len(codes) < window + octave:
        return []
    hashes = (sums[window:] - sums[:-window]) * inverse[:len(codes) - window + 1]
    here, last = hashes[boundaries], len(hashes) - 1
    which, periods = [], []
    for q in range(octave, window):
        there = boundaries + q
        hit = np.flatnonzero((here == hashes[np.minimum(there, last)]) & (there + window <= highs))
        which.append(hit)
        periods.append(np.full(len(hit), q))
    which, periods = np.concatenate(which), np.concatenate(periods)
    order = np.argsort(which, kind="stable")
    which, periods, out = which[order], periods[order], []
    starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else []
    for a, b in zip(starts, [*starts[1:], len(which)]):
        k = int(which[a])
        out += [(k, *f) for f in solve_tile(codes, int(boundaries[k]), int(lows[k]), int(highs[k]), octave,
                                            periods[a:b].tolist())]
    return out


def hash_sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the words' random numbers weighed by powers of ``BASE``, and the inverse powers."""
    n = len(codes)
    power, inverse = (np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)], dtype=np.uint64)
                      for b in (BASE, pow(BASE, -1, 1 << 64)))
    terms = mixed(codes.astype(np.uint64) + np.uint64(1)) * power[:-1]
    return np.r_[np.uint64(0), np.cumsum(terms, dtype=np.uint64)], inverse


def merged(fragments: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(text, period, x, y) with those of a text and period that meet made one."""
    out: list[tuple[int, int, int, int]] = []
    for text, q, x, y in sorted(fragments):
        if out and out[-1][:2] == (text, q) and x <= out[-1][3]:
            out[-1] = (text, q, out[-1][2], max(out[-1][3], y))
        else:
            out.append((text, q, x, y))
    return out


def long_enough(q: int, x: int, y: int) -> bool:
    return y - x + q >= max(LEAST_WORDS, LEAST_PERIODS * q)


def octaves(n: int) -> list[int]:
    """The octaves of periods that n words can hold."""
    return [1 << o for o in range(max(n, 0).bit_length()) if n >= max(LEAST_WORDS, LEAST_PERIODS << o)]


def text_runs(codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, period, x, y) of all runs of texts that lie one after the other in ``codes``."""
    sums, inverse = hash_sums(codes)
    starts, sizes, found = bounds[:-1], np.diff(bounds), []
    for octave in octaves(int(sizes.max(initial=0))):
        texts = np.flatnonzero(sizes >= max(LEAST_WORDS, LEAST_PERIODS * octave))
        counts = (sizes[texts] - 3 * octave) // octave + 1
        text = np.repeat(texts, counts)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        lows = starts[text]
        found += [(int(text[k]), q, x - int(lows[k]), y - int(lows[k])) for k, q, x, y in octave_fragments(
            codes, sums, inverse, octave, lows + place * octave, lows, bounds[text + 1])]
    return [f for f in merged(found) if long_enough(*f[1:])]


def tile_groups(codes: np.ndarray, group_words: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(octave, first boundary, number of boundaries, words) of one long text; the words begin
    ``octave`` before the first boundary, or with the text."""
    n = len(codes)
    for octave in octaves(n):
        count, each = (n - 3 * octave) // octave + 1, max(1, group_words // octave)
        for k in range(0, count, each):
            held = min(each, count - k)
            yield octave, k * octave, held, codes[max(0, (k - 1) * octave):(k + held - 1) * octave + 5 * octave]


def group_fragments(codes: np.ndarray, octave: int, first: int, count: int) -> list[tuple[int, int, int]]:
    """(period, x, y) in the text's own places, for one group of tiles."""
    shift = max(0, first - octave)  # the text's place of the first word here
    boundaries = first - shift + octave * np.arange(count)
    sums, inverse = hash_sums(codes)
    ends = np.full(count, len(codes))
    found = octave_fragments(codes, sums, inverse, octave, boundaries, np.zeros(count, np.int64), ends)
    return [(q, x + shift, y + shift) for _, q, x, y in merged([(0, *f[1:]) for f in found])]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of Arrow texts as lists without empty parts, and their codes in a row."""
    parts = pc.ascii_split_whitespace(rebased(texts))
    parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
    words, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    kept = pc.greater(pc.binary_length(words), 0)
    offsets = np.r_[0, np.cumsum(kept.to_numpy(zero_copy_only=False), dtype=np.int64)][offsets]
    words = words.filter(kept)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), words.dictionary_encode().indices.to_numpy()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  group_words: int = GROUP_WORDS) -> DataFrame:
    """A row per row of ``docs``: (id, n_words, runs, collapsed, collapsed_sha256). ``runs`` are by
    start and then period. ``collapsed`` is the text without the words that some run contains after
    its first period, joined by one space; null where there is no run, as only white space would
    differ. The digest is of the words left, in every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("fp", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fields = ["what", "id", "fp", "n", "period", "x", "y", "data"]
    schema = f"what int, id {kind}, fp bigint, n bigint, period bigint, x bigint, y bigint, data binary"
    CLEAN, TEXT, FRAGMENT, TILES = range(4)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                words, codes = _words(text_column(block, "text"))
                bounds = words.offsets.to_numpy()
                joined = pc.binary_join(words, pa.scalar(" ", words.type.value_type)).to_pylist()
                sizes = np.diff(bounds)
                short = sizes <= group_words
                # (what, row, n, period, x, y, data)
                out = []
                held = np.r_[0, np.cumsum(np.where(short, sizes, 0))]
                found = text_runs(codes if short.all() else codes[np.repeat(short, sizes)], held)
                out += [(FRAGMENT, text, 0, q, x, y, None) for text, q, x, y in found]
                dirty = {f[0] for f in found} | set(np.flatnonzero(~short).tolist())
                for i, (n, text) in enumerate(zip(sizes.tolist(), joined)):
                    raw = text.encode()
                    out.append((TEXT, i, n, 0, 0, 0, raw) if i in dirty else
                               (CLEAN, i, n, 0, 0, 0, hashlib.sha256(raw).digest()))
                for i in np.flatnonzero(~short).tolist():
                    own = codes[bounds[i]:bounds[i + 1]].astype(np.int32)
                    for octave, first, count, some in tile_groups(own, group_words):
                        out.append((TILES, i, 0, octave, first, count, some.tobytes()))
                        if len(out) >= 64:
                            yield packed(block, out)
                            out = []
                yield packed(block, out)

    def packed(block: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 7
        at = pa.array(columns[1], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), block.column("id").take(at), block.column("fp").take(at),
             *[pa.array(c, pa.int64()) for c in columns[2:6]], pa.array(columns[6], pa.binary())], names=fields)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                octave, first, count, data = (batch.column(c)[i].as_py() for c in ("period", "x", "y", "data"))
                found = group_fragments(np.frombuffer(data, np.int32), octave, first, count)
                columns = list(zip(*found)) or [()] * 3
                at = pa.array([i] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("fp").take(at), *[pa.array(c, pa.int64()) for c in columns]],
                    names=["id", "fp", "period", "x", "y"])

    first = written(rows.mapInArrow(tile, schema), "periodic-tiles")
    groups = first.filter(F.col("what") == TILES).select("id", "fp", "period", "x", "y", "data")
    groups = groups.repartition("id", "fp", "period", "x").mapInArrow(
        solve, f"id {kind}, fp bigint, period bigint, x bigint, y bigint")
    fragments = first.filter(F.col("what") == FRAGMENT).select("id", "fp", "period", "x", "y").unionByName(groups)
    runs = stitch(fragments).groupBy(F.col("id").alias("of"), F.col("fp").alias("of_fp")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    texts = first.filter(F.col("what") == TEXT).select("id", "fp", F.col("n").alias("n_words"), F.col("data").cast("string").alias("text"))
    texts = texts.join(runs, F.col("id").eqNullSafe(F.col("of")) & (F.col("fp") == F.col("of_fp")), "left")
    texts = texts.select("id", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text").mapInArrow(
        collapse, f"id {kind}, n_words bigint, runs {RUNS}, collapsed string, collapsed_sha256 string")
    clean = first.filter(F.col("what") == CLEAN).select(
        "id", F.col("n").alias("n_words"), F.array().cast(RUNS).alias("runs"), F.lit(None).cast("string").alias("collapsed"),
        F.lower(F.hex("data")).alias("collapsed_sha256"))
    return clean.unionByName(texts)


def stitch(fragments: DataFrame) -> DataFrame:
    """(id, fp, start, length, period) of the runs of fragments (id, fp, period, x, y)."""
    same = Window.partitionBy("id", "fp", "period").orderBy("x", "y")
    before = F.max("y").over(same.rowsBetween(Window.unboundedPreceding, -1))
    # Rows of equal id and text have equal fragments.
    apart = fragments.distinct().withColumn("begins", (before.isNull() | (before < F.col("x"))).cast("int"))
    whole = apart.withColumn("piece", F.sum("begins").over(same)).groupBy("id", "fp", "period", "piece").agg(
        F.min("x").alias("start"), F.max("y").alias("y"))
    length = F.col("y") - F.col("start") + F.col("period")
    whole = whole.select("id", "fp", "start", length.alias("length"), "period")
    return whole.filter(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period")))


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, digests = [], []
        for text, runs in zip(batch.column("text"), batch.column("runs")):
            words, found = text.as_py().split(" "), runs.as_py()
            dropped = np.zeros(len(words) + 1, np.int64)
            for r in found:
                dropped[r["start"] + r["period"]] += 1
                dropped[r["start"] + r["length"]] -= 1
            left = " ".join(w for w, d in zip(words, np.cumsum(dropped).tolist()) if not d)
            kept.append(left if found else None)
            digests.append(hashlib.sha256(left.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_words"), batch.column("runs"), pa.array(kept, pa.string()),
             pa.array(digests, pa.string())], names=["id", "n_words", "runs", "collapsed", "collapsed_sha256"])


def best_run(runs: Column) -> Column:
    """The run with the greatest length by period, compared exactly; the first of equal ones."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text), with a periodic end put into a tenth of the texts: the words from a place on
    become repetitions of those that stand there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    picked = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    picked = picked.withColumn("n", F.size("w").cast("bigint")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    picked = picked.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.when(
        i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.array_join(F.transform(place, lambda i: F.get("w", i.cast("int"))), " ")
    return picked.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(with_repeats(docs)).withColumn("best", best_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")
