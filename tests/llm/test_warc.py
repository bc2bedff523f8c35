"""WARC files: exact round trips, and splits at any place."""

import base64
import hashlib
import io
import zlib

from gaugeframe.llm.warc import _member, list_files, members, op6_warc, read_warc, write_warc

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=0):
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        target = first[html or ""] if len(payload) >= least else i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((f"urn:page:{'' if i is None else i}", "response" if target == i else "revisit",
                    None if target == i else f"urn:page:{target}", digest, len(payload)))
    return sorted(out, key=str)


def found(records):
    return sorted(((r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes)
                   for r in records.collect()), key=str)


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}\r\nx", ("<p>é%d</p>\r\n\r\n" % (i % 7)) * (i % 5)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", "x"), (7, "again", rows[7][2]), (102, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([r + (1,) for r in rows], SCHEMA + ", digest int").repartition(3)
    for least in (0, 20):
        files = write_warc(df, str(tmp_path / f"w{least}"), min_bytes=least)
        assert files.agg({"records": "sum"}).first()[0] == len(rows)
        for split in (37, 5_000, 1 << 20):
            if split > 37 or least:
                assert found(read_warc(files, split if split > 37 else 700)) == expected(rows, least)
    assert found(read_warc(list_files(spark, str(tmp_path / "w0")))) == expected(rows)


def test_every_split_owns_each_record_once():
    tricky = b"\x1f\x8b\x08" * 50 + bytes(range(256)) * 3
    data, at = b"", []
    for i in range(12):
        at.append(len(data))
        data += _member("response", str(i), "u", str(i), tricky * (i % 3))
    for width in (1, 13, 100, 1000, len(data)):
        got = [o for s in range(0, len(data), width) for o, _ in members(io.BytesIO(data), s, s + width, 64)]
        assert got == at
    # A truncated last member is left out; the others stay.
    assert [o for o, _ in members(io.BytesIO(data[:-3]), 0, len(data))] == at[:-1]
    assert zlib.decompress(data, 31).startswith(b"WARC/1.1")


def test_registered_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    got = sorted(((f"urn:page:{r.page_id}", r.record_type, r.refers_to and f"urn:page:{r.refers_to}", r.payload_digest,
                   r.payload_bytes) for r in op6_warc(spark, sf_dir).collect()), key=str)
    assert got == expected([tuple(p) for p in pages])


def test_empty(spark, tmp_path):
    files = write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert read_warc(files).count() == 0
