"""Secret scans: an Aho-Corasick automaton finds keywords, anchored patterns look at text near
a hit only, and tokens that embed a checksum are validated.

Row-wise: nothing is shuffled. A null text reads as empty; rows with equal ids are scanned each
for itself; an empty table gives an empty result. Extra columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import blocks, text_column

# The kinds and their patterns.
KINDS = ["assign", "access", "hex", "github", "npm"]
ASSIGN = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
# Tokens of 30 base-62 characters and six more that hold their CRC-32.
CHECKED = {"github": (["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], r"gh[pousr]_([0-9A-Za-z]{36})"),
           "npm": (["npm_"], r"npm_([0-9A-Za-z]{36})")}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_ok(body: str) -> bool:
    """Whether the last six characters are the CRC-32 of the others in base 62."""
    n, digits = crc32(body[:-6].encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits == body[-6:]


def _automaton():
    """Keywords over lower-cased text. A run of hex digits has no keyword, but each run that is
    long enough begins with four hex digits, which are rare in prose."""
    import ahocorasick

    found: dict[str, list[tuple[str, int]]] = {}
    for word in ASSIGN_WORDS:
        found.setdefault(word, []).append(("assign", len(word)))
    found["akia"] = [("access", 4)]
    for kind, (prefixes, _) in CHECKED.items():
        for prefix in prefixes:
            found[prefix] = [(kind, len(prefix))]
    digits = "0123456789abcdef"
    for a in digits:
        for b in digits:
            for c in digits:
                for d in digits:
                    found.setdefault(a + b + c + d, []).append(("hex", 4))
    out = ahocorasick.Automaton()
    for word, hits in found.items():
        out.add_word(word, hits)
    out.make_automaton()
    return out


def _patterns() -> dict[str, re.Pattern]:
    return {"assign": re.compile(ASSIGN, re.ASCII | re.IGNORECASE), "access": re.compile(ACCESS),
            "hex": re.compile(HEX)} | {k: re.compile(p) for k, (_, p) in CHECKED.items()}


_SCANNER: list = []


def _accept(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= MIN_VALUE
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    if kind == "hex":
        return len(match[0]) >= MIN_HEX
    return checksum_ok(match[1])


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, leftmost and non-overlapping per kind, by start and
    then kind. A match that fails its test still uses up its text."""
    # Lower-casing bytes touches A-Z only and keeps every position.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if not _SCANNER:  # made once by each task's process; it does not travel
        _SCANNER.extend([_automaton(), _patterns()])
    (automaton, patterns), used, spans = _SCANNER, dict.fromkeys(KINDS, 0), []
    for last, hits in automaton.iter(lowered):
        for kind, size in hits:
            start = last + 1 - size
            if start < used[kind]:
                continue
            match = patterns[kind].match(text, start)
            if match is None or kind == "hex" and match.end() <= last:
                continue
            used[kind] = match.end()
            if _accept(kind, match):
                spans.append((start, match.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans`` array<struct<kind, start, end>>."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                found = [[{"kind": k, "start": a, "end": b} for a, b, k in find_secrets(t)]
                         for t in text_column(block, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(found, shape)],
                                                 names=["id", "spans"])

    out = rows.mapInArrow(
        scan, f"id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")
    return out.withColumnRenamed("id", id_col)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
