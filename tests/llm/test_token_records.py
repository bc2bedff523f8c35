"""Token records: exact round trips, framing, splits, shuffled reads."""

import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from gaugeframe.llm.token_records import (
    Crc32c, Encoder, RecordFile, encoder_parts, op11_token_records, read_shuffled, read_token_records,
    splits_at_spaces, write_token_records,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


def tokenizer(path=PATH):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    rng = np.random.default_rng(1)
    parts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in (0, 1, 7, 8, 63, 64, 65, 128, 129, 1000, 4097)]
    for width in (8, 64):
        assert Crc32c(width).masked(parts).tolist() == [slow_crc32c(p) for p in parts]
    # A published value: the nine digits give e3069283 before the mask.
    assert slow_crc32c(b"123456789") == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF


HARD = ["", " ", "a", "It's  don't\tWE'LL 12ab 3.5!!", "<|endoftext|> x<|startoftext|>y <|EndOfText|>", "é ́x",
        "ΟΔΟΣ ΟΔΟΣ. σ Σ b", "日本語 テキスト", "\x1c\x1f\x00 \x0b\x0c", "😀😀 'S 'sx x's", "İ ẞ ﬁ", "x" * 500,
        "Ünïted, ÉCOLE! Ɔa1 ƎB. ŉ Straße? \"Wort\" (203) [a]", "it's. x.'s y'.s don\"t ''s a.b,c;d a)(b 0a.1b",
        "Aa,<|endoftext|>Bb. <|endOFtext|>c)", "a\u0301 e.\u0301 A\u030a\u0327 \u212b \u0344", "\u00d7\u00f7 \u01c5. \u023a"]


def test_encoder_is_the_tokenizer():
    spec = open(PATH, encoding="utf-8").read()
    encode, plain = Encoder(*encoder_parts(spec)), tokenizer()
    assert encode.by_word and encode.pieces
    for _ in range(2):  # the second time from memory
        flat, bounds = encode(pa.array(HARD, pa.large_string()))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
            plain.encode(t, add_special_tokens=False).ids for t in HARD]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not splits_at_spaces(json.load(open(other, encoding="utf-8")))
    flat, bounds = Encoder(*encoder_parts(open(other, encoding="utf-8").read()))(pa.array(HARD, pa.large_string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
        tokenizer(other).encode(t, add_special_tokens=False).ids for t in HARD]


def expected(rows):
    plain, out, start = tokenizer(), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, ids))
        start += len(ids)
    return out


def found(df):
    return sorted(((r["id"], r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in df.collect()),
                  key=lambda r: r[1])


def test_round_trip(spark, tmp_path):
    rows = [(i * 3 - 20, t) for i, t in enumerate(HARD)] + [(500, None), (None, "no id"), (501, "again " * 30_000)]
    df = spark.createDataFrame([(t, i, 7, "x") for i, t in rows], "text string, doc_id bigint, start int, ids string")
    files = write_token_records(df.repartition(4), str(tmp_path / "a"), PATH, file_bytes=400)
    assert files.count() > 1
    for split in (9_000, 1 << 20):
        assert found(read_token_records(files, split)) == expected(rows)
    shuffled = read_shuffled(files, 5)
    assert found(shuffled) == expected(rows)
    order = [r["start"] for r in shuffled.collect()]
    assert order != sorted(order) and order == [r["start"] for r in read_shuffled(files.repartition(3), 5).collect()]
    assert order != [r["start"] for r in read_shuffled(files, 6).collect()]


def test_repeated_rows(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (2, "a b")]
    files = write_token_records(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "r"), PATH)
    got = found(read_token_records(files))
    assert sorted(g[0] for g in got) == [1, 1, 1, 2] and got[-1][0] == 2
    assert [g[1] for g in got] == np.cumsum([0] + [len(g[2]) for g in got])[:-1].tolist()


def test_damage_is_found(spark, tmp_path):
    files = write_token_records(spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string"),
                                str(tmp_path / "d"), PATH)
    path = files.first()["path"]
    data = bytearray(open(path, "rb").read())
    for place in (0, 9, 14, len(data) - 6, len(data) - 1):
        bad = bytearray(data)
        bad[place] ^= 1
        other = str(tmp_path / f"bad{place}")
        open(other, "wb").write(bad)
        open(other + ".idx", "wb").write(open(path + ".idx", "rb").read())
        with pytest.raises(ValueError):
            RecordFile(other).read(0, 1)


def test_empty_table(spark, tmp_path):
    files = write_token_records(spark.createDataFrame([], "doc_id bigint, text string"), str(tmp_path / "e"), PATH)
    assert read_token_records(files).count() == 0 and read_shuffled(files).count() == 0


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in expected(map(tuple, docs))]
    got = op11_token_records(spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(want)
