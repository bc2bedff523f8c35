"""Secret scans against plain regular expressions."""

import random
import re

from gaugeframe.llm.secret_scan import ASSIGN, BASE62, checksum_ok, find_secrets, scan_secrets


def plain(text):
    found = [(m.start(), m.end(), "assign") for m in re.finditer(ASSIGN, text, re.A | re.I) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[2])))


def test_same_as_plain_patterns():
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", ":", "=", ' "', "'", " ", "AKIA", "ABCDEFGH12",
             "deadbeef", "DEADBEEF", "0123456789ab", "é", "ſ", "K", "xyz", "\n", "/+", "-"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in find_secrets(text) if s[2] in ("assign", "access", "hex")] == plain(text)


def token(prefix, body):
    from zlib import crc32
    n, digits = crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return prefix + body + digits


def test_checksummed_tokens():
    good = token("ghp_", "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5")
    assert find_secrets(f"x {good} y") == [(2, 2 + len(good), "github")]
    assert find_secrets(good[:-1] + ("a" if good[-1] != "a" else "b")) == []
    assert not checksum_ok("a" * 36)


def test_edges(spark):
    rows = [(1, None, "a"), (1, "", "a"), (None, "token=abcdef", "b"), (2, "x" * 200_000 + " secret: 123456", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.spans]) for r in scan_secrets(df).collect())
    assert got == [("1", []), ("1", []), ("2", [("assign", 200_001, 200_015)]), ("None", [("assign", 0, 12)])]
    assert scan_secrets(df.limit(0)).count() == 0


def test_registered_query(spark, sf_dir):
    """Counts, digest and joined spans of every text against plain patterns."""
    import hashlib

    from gaugeframe.llm.secret_scan import op2_secret_scan

    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        base = plain(r.text or "")
        kinds = [k for _, _, k in base]
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        every = ",".join(f"{k}:{a}:{b}" for a, b, k in find_secrets(r.text or ""))
        want[r.doc_id] = (*[kinds.count(k) for k in ("assign", "access", "hex")], hashlib.sha256(joined.encode()).hexdigest(), every)
    got = op2_secret_scan(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got} == want
    assert sum(w[0] + w[1] + w[2] for w in want.values())
