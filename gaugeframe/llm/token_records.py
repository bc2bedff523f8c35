"""Token ids as length-delimited binary records, with an index of offsets beside each file.

A file is a run of records, each framed as

    uint64 length | uint32 check of the length | payload | uint32 check of the payload

where a check is the masked CRC-32C of those bytes (rotated right by 15 bits, plus a constant) and
everything is little-endian. A payload is an int64 document id, a uint32 of flags (1: the id is
null; 2 or 4: bytes of a token id) and the token ids, the last of which is the end id. The index
file ``<file>.idx`` holds a pair of uint64 for each record and one for the end: where the record
begins, and how many token ids of the file come before it. So a reader takes any records, in any
order, without a scan.

Documents lie in ascending order of id (null first; rows with equal ids by a hash of their text),
dealt to tasks by ranges. Null and empty texts give a record with the end id only. Repeated rows
give a record each. An empty table gives no file. Ids are bigint; other columns are left out.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import shared_path, written
from .text import blocks, rebased, text_column
from .warc import open_folder

FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
MAX_TASKS = 50_000
#: Words and pieces whose ids a task remembers; beyond it the memory starts afresh.
KNOWN_PIECES = 300_000
END_ID = 2
FILES = "part int, seq int, path string, bytes bigint, records bigint, ids bigint"

# The reflected CRC-32C polynomial and the mask of the record format.
CRC32C = 0x82F63B78
MASK = 0xA282EAD8
FRAME, FRAME_BYTES = "<QI", 12
PAYLOAD, PAYLOAD_BYTES = "<qI", 12
NULL_ID = 1


# ---- masked checksums of many byte strings at once

def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(CRC32C), np.uint32(0))
    return table


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as four tables of its values by byte."""
    return (tables[0][crc & np.uint32(255)] ^ tables[1][(crc >> np.uint32(8)) & np.uint32(255)]
            ^ tables[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ tables[3][crc >> np.uint32(24)])


class Crc32c:
    """CRC-32C by its linearity: rows of ``width`` bytes are looked up column by column, then
    each row is moved to its distance from the end by maps for powers of two."""

    def __init__(self, width: int = 64):
        byte = _byte_table()
        self.width, each = width, np.arange(256, dtype=np.uint32)
        one = np.stack([byte[each], each, each << np.uint32(8), each << np.uint32(16)])  # one zero byte on
        self.moves = [one]  # moves[b]: 2**b zero bytes
        for _ in range(47):
            last = self.moves[-1]
            self.moves.append(np.stack([_apply(last, t) for t in last]))
        columns = [byte]
        for _ in range(width - 1):
            columns.append(_apply(one, columns[-1]))
        self.columns = columns[::-1]

    def _moved(self, crc: np.ndarray, steps: np.ndarray) -> np.ndarray:
        crc = crc.copy()
        for bit in range(int(steps.max(initial=0)).bit_length()):
            on = np.flatnonzero(steps >> bit & 1)
            crc[on] = _apply(self.moves[bit], crc[on])
        return crc

    def masked(self, parts: list[bytes]) -> np.ndarray:
        if not parts:
            return np.zeros(0, np.uint32)
        sizes = np.array([len(p) for p in parts], np.int64)
        rows = np.maximum(-(-sizes // self.width), 1)
        ends = np.cumsum(rows)
        padded = np.zeros((int(ends[-1]), self.width), np.uint8)
        flat = padded.reshape(-1)
        for part, size, end in zip(parts, sizes.tolist(), (ends * self.width).tolist()):
            if size:
                flat[end - size:end] = np.frombuffer(part, np.uint8)
        crc = np.zeros(len(padded), np.uint32)
        for j, column in enumerate(self.columns):
            crc ^= column[padded[:, j]]
        left = np.repeat(ends, rows) - 1 - np.arange(len(padded))
        whole = np.bitwise_xor.reduceat(self._moved(crc, left * self.width), ends - rows)
        crc = ~(whole ^ self._moved(np.full(len(parts), 0xFFFFFFFF, np.uint32), sizes))
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


# ---- tokenizing

# The normalizer and the splitting of the tokenizers whose words are cut here.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Words of printable ASCII without apostrophe and of Latin letters that lower-case to one such
#: letter; what these tokenizers make of them is plain: runs of letters, digits, runs of others.
PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]+")
#: A letter, then a mark: always two pieces.
MARKS = "([A-Za-z])([.,;:!?\")\\]])"
PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u02af]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")


def splits_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer drops white space before it forms tokens, so that the tokens of a text
    are those of its words in a row."""
    first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {}])[0]
    added = [t["content"] for t in spec.get("added_tokens", [])]
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and bool(spec["model"].get("end_of_word_suffix")) and not any(set(" \t\n\r\x0b\x0c") & set(t) for t in added))


def encoder_parts(spec: str) -> tuple[str, str | None, bytes, bool]:
    """What an ``Encoder`` is made of: the tokenizer; the same one for pieces alone, if its way of
    splitting is known; which of its tokens end a word; whether it drops white space."""
    parsed = json.loads(spec)
    by_word = splits_at_spaces(parsed)
    if not by_word or parsed["normalizer"] != NORMALIZER or parsed["pre_tokenizer"] != SPLIT:
        return spec, None, b"", by_word
    suffix, vocab = parsed["model"]["end_of_word_suffix"], parsed["model"]["vocab"]
    last = np.zeros(max(vocab.values()) + 1, bool)
    last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
    bare = parsed | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {
        "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, SPLIT["pretokenizers"][1]]}}
    return spec, json.dumps(bare), last.tobytes(), True


class Encoder:
    """Token ids of Arrow texts by a tokenizer given by ``encoder_parts``. Where white space is
    dropped anyway, each distinct word is encoded once and the ids of the texts are put together;
    plain words of known tokenizers are cut into pieces, of which there are far fewer."""

    def __init__(self, spec: str, pieces: str | None, last: bytes, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads also keep memory each
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(spec), by_word
        self.pieces = Tokenizer.from_str(pieces) if pieces else None
        self.last = np.frombuffer(last, bool)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.bounds, self.pool, self.used = np.zeros(1, np.int64), np.zeros(1 << 16, self.kind), 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), 1000)
                for e in self.tokenizer.encode_batch_fast(texts[i:i + 1000], add_special_tokens=False)]

    def _add(self, flat: np.ndarray, ends: np.ndarray) -> None:
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), self.kind)])
        self.pool[self.used:self.used + len(flat)] = flat
        self.bounds = np.concatenate([self.bounds, self.used + ends])
        self.used += len(flat)

    def _add_pieces(self, pieces: list[str], counts: np.ndarray | None = None) -> None:
        """Words of so many pieces each (one, if not given)."""
        lines = [" ".join(pieces[j:j + 500]) for j in range(0, len(pieces), 500)]
        ids = np.concatenate([np.array(e.ids, self.kind) for i in range(0, len(lines), 20)
                              for e in self.pieces.encode_batch_fast(lines[i:i + 20], add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1  # a piece ends with a token that ends a word
        self._add(ids, ends if counts is None else ends[np.cumsum(counts) - 1])

    def _places(self, coded: pa.Array) -> np.ndarray:
        """Where the ids of each distinct word are; new words are encoded. Those of letters alone
        are remembered for the next texts, others seldom occur again."""
        words = coded.to_numpy(zero_copy_only=False).tolist()
        if len(self.places) + len(words) > KNOWN_PIECES:
            self._forget()
        else:  # the others of the last texts
            self.bounds = self.bounds[:len(self.places) + 1]
            self.used = int(self.bounds[-1])
        place = np.array([self.places.get(w, -1) for w in words], np.int64)
        new = place < 0
        if self.pieces:
            letters = pc.match_substring_regex(coded, "^[a-z]+$").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(new & letters)
            if len(at):
                some = [words[i] for i in at]
                self._add_pieces(some)
                place[at] = len(self.places) + np.arange(len(at))
                self.places.update(zip(some, place[at].tolist()))
            cut, counts, at = [], [], []
            for i in np.flatnonzero(new & ~letters).tolist():
                w = words[i]
                if PLAIN.fullmatch(w) and not ("<" in w and any(t in w for t in self.special)):
                    parts = [w.lower()] if w.isalpha() else PIECE.findall(w.lower())
                    cut += parts
                    counts.append(len(parts))
                    at.append(i)
            if at:
                place[at] = len(self.bounds) - 1 + np.arange(len(at))
                self._add_pieces(cut, np.array(counts))
        at = np.flatnonzero(place < 0)
        place[at] = len(self.bounds) - 1 + np.arange(len(at))
        found = self._ids([words[i] for i in at])
        sizes = list(map(len, found))
        self._add(np.fromiter((i for ids in found for i in ids), self.kind, sum(sizes)), np.cumsum(sizes, dtype=np.int64))
        return place

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins (one more than texts)."""
        if not self.by_word:
            found = self._ids(texts.to_pylist())
            bounds = np.cumsum([0, *map(len, found)], dtype=np.int64)
            return np.fromiter((i for ids in found for i in ids), self.kind, int(bounds[-1])), bounds
        if self.pieces:  # fewer distinct words: marks after a letter stand alone, letters are small
            texts = pc.replace_substring_regex(texts, MARKS, r"\1 \2")
            if not any(pc.any(pc.match_substring(texts, t, ignore_case=True)).as_py() for t in self.special):
                texts = pc.ascii_lower(rebased(texts))
        parts = pc.ascii_split_whitespace(rebased(texts))
        parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
        coded = parts.flatten().dictionary_encode()
        firsts = parts.offsets.to_numpy().astype(np.int64)
        firsts -= firsts[0]
        place = self._places(coded.dictionary)
        first, size, code = self.bounds[place], self.bounds[place + 1] - self.bounds[place], coded.indices.to_numpy()
        sizes = size[code]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        at = np.repeat(first[code] - upto[:-1], sizes) + np.arange(int(upto[-1]))
        return self.pool[at], upto[firsts]


# ---- writing

def _index_path(path: str) -> str:
    return path + ".idx"


def write_token_records(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                        text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row under ``folder``; returns the files as a written table (part, seq,
    path, bytes, records, ids), whose order by part and seq is the order of the documents. Files
    get fresh names, so a task that runs twice damages nothing; only listed files count."""
    with open(tokenizer_path, encoding="utf-8") as f:
        parts = encoder_parts(f.read())  # workers need no copy of the file
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        root, at = open_folder(folder)
        encode, check, short = Encoder(*parts), Crc32c(), Crc32c(8)
        end, part = np.array([end_id], encode.kind), TaskContext.get().partitionId()
        done, out, path, offset, ids, index = [], None, "", 0, 0, []

        def close() -> None:
            out.close()
            entries = np.array([*index, (offset, ids)], "<u8")
            with root.open_output_stream(_index_path(f"{at}/{path}"), compression=None) as side:
                side.write(entries.tobytes())
            done.append((part, len(done), f"{folder.rstrip('/')}/{path}", offset, len(index), ids))

        for batch in batches:
            for block in blocks(batch, "text"):
                flat, bounds = encode(text_column(block, "text"))
                payloads, counts = [], []
                for key, a, b in zip(block.column("id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    flags = encode.width | (NULL_ID if key is None else 0)
                    payloads.append(struct.pack(PAYLOAD, key or 0, flags) + flat[a:b].tobytes() + end.tobytes())
                    counts.append(b - a + 1)
                lengths = [len(p).to_bytes(8, "little") for p in payloads]
                for payload, n, size, c, d in zip(payloads, counts, lengths, short.masked(lengths).tolist(),
                                                  check.masked(payloads).tolist()):
                    if out is None:
                        root.create_dir(at, recursive=True)
                        path, offset, ids, index = f"{uuid.uuid4().hex}.tokens", 0, 0, []
                        out = root.open_output_stream(f"{at}/{path}", compression=None)
                    out.write(b"".join((size, c.to_bytes(4, "little"), payload, d.to_bytes(4, "little"))))
                    index.append((offset, ids))
                    offset, ids = offset + FRAME_BYTES + len(payload) + 4, ids + n
                    if offset >= file_bytes:
                        close()
                        out = None
        if out is not None:
            close()
        columns = list(zip(*done)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3))],
            names=[f.split()[0] for f in FILES.split(", ")])

    return written(rows.mapInArrow(save, FILES), "token-files")


# ---- reading

class RecordFile:
    """A file of records with its index, read by ranges."""

    def __init__(self, uri: str):
        self.uri, (self.root, self.at) = uri, open_folder(uri)
        self.source = self.root.open_input_file(self.at)
        with self.root.open_input_file(_index_path(self.at)) as side:
            self.index = np.frombuffer(side.read(), "<u8").reshape(-1, 2).astype(np.int64)
        self.check, self.short = Crc32c(), Crc32c(8)

    def owned(self, start: int, end: int) -> tuple[int, int]:
        """The records that begin in these bytes: the first, and the one after the last."""
        first, last = np.searchsorted(self.index[:-1, 0], [start, end])
        return int(first), int(last)

    def read(self, first: int, last: int) -> tuple[list[int | None], np.ndarray, list[np.ndarray]]:
        """Ids of documents, token ids before each in the file, and their token ids, for records
        that lie next to each other; every length and checksum is verified."""
        offsets = self.index[first:last + 1, 0]
        self.source.seek(int(offsets[0]))
        data = self.source.read(int(offsets[-1] - offsets[0]))
        sizes, payloads, wanted = [], [], []
        for a, b in zip((offsets[:-1] - offsets[0]).tolist(), (offsets[1:] - offsets[0]).tolist()):
            size, check = struct.unpack_from(FRAME, data, a)
            if size != b - a - FRAME_BYTES - 4:
                raise ValueError(f"{self.uri}: a record's length differs from the index")
            sizes.append(data[a:a + 8])
            payloads.append(data[a + FRAME_BYTES:b - 4])
            wanted.append((check, int.from_bytes(data[b - 4:b], "little")))
        found = np.stack([self.short.masked(sizes), self.check.masked(payloads)], axis=1)
        if (found != np.array(wanted, np.uint32).reshape(-1, 2)).any():
            raise ValueError(f"{self.uri}: a checksum does not match")
        keys, tokens = [], []
        for payload in payloads:
            key, flags = struct.unpack_from(PAYLOAD, payload)
            keys.append(None if flags & NULL_ID else key)
            tokens.append(np.frombuffer(payload, f"<u{flags & 6}", offset=PAYLOAD_BYTES).astype("<u4"))
        return keys, self.index[first:last, 1], tokens

    def close(self) -> None:
        self.source.close()


def with_bases(files: DataFrame, group: int = 1000) -> DataFrame:
    """``files`` with ``base``: the token ids of all files before each. Sums of ``group`` parts at
    a time, so that no task sorts all files."""
    files = files.withColumn("bunch", F.floor(F.col("part") / group))
    inside = Window.partitionBy("bunch").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy("bunch").agg(F.sum("ids").alias("all"))
    before = Window.orderBy("bunch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bunch", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("earlier"))
    inner = files.withColumn("base", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return inner.join(sums, "bunch").withColumn("base", F.col("base") + F.col("earlier")).drop("bunch", "earlier")


def _rows(keys: list, starts: np.ndarray, tokens: list[np.ndarray], more: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()),
                                       "ids": pa.array([t.tobytes() for t in tokens], pa.binary())} | more)


def read_token_records(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(id, start, ids) of the records of written files: ``start`` is the number of token ids of
    all documents before, ``ids`` are little-endian unsigned 32-bit numbers. A task per byte range;
    it owns the records that begin there."""
    ranges = with_bases(files).select("path", "base", "bytes", F.explode(F.expr(
        f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("first"))
    ranges = written(ranges.select("path", "base", "first", F.least(
        F.col("bytes"), F.col("first") + F.lit(int(split_bytes))).alias("last")), "token-ranges")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = RecordFile(row["path"])
                first, last = source.owned(row["first"], row["last"])
                if first < last:
                    keys, before, tokens = source.read(first, last)
                    yield _rows(keys, before + row["base"], tokens, {})
                source.close()

    tasks = max(1, min(ranges.count(), MAX_TASKS))
    return ranges.repartition(tasks, "path", "first").mapInArrow(read, "id bigint, start bigint, ids binary")


def read_shuffled(files: DataFrame, seed: int = 0) -> DataFrame:
    """(id, start, ids, place) in one global random order, by ``place``: the indexes are read,
    their entries are sorted by a hash of seed and place in the corpus, and records are fetched by
    offset. Equal for every partitioning and repetition."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = RecordFile(row["path"])
                n = len(source.index) - 1
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([row["path"]] * n, pa.string()), "record": pa.array(np.arange(n), pa.int64()),
                    "start": pa.array(source.index[:-1, 1] + row["base"], pa.int64())})
                source.close()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, RecordFile] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                path, record, start = (batch.column(c)[i].as_py() for c in ("path", "record", "start"))
                if path not in held:
                    if len(held) == 16:
                        held.pop(next(iter(held))).close()
                    held[path] = RecordFile(path)
                keys, _, tokens = held[path].read(record, record + 1)
                yield _rows(keys, np.array([start]), tokens, {"place": batch.column("place").slice(i, 1)})

    found = with_bases(files).select("path", "base").mapInArrow(entries, "path string, record bigint, start bigint")
    # Each record holds an end id at least, so starts differ.
    placed = written(found.withColumn("place", F.xxhash64(F.lit(seed), "start")), "token-places")
    return placed.orderBy("place", "start").mapInArrow(fetch, "id bigint, start bigint, ids binary, place bigint")


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = write_token_records(docs, shared_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_records(files).select(
        F.col("id").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
