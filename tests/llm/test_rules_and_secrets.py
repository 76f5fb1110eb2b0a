"""Quality rules against DuckDB, secret scans against hand-made cases, masking."""

from __future__ import annotations

import base64
import json

import duckdb
import pytest

from appraise.llm import quality_rules, secrets
from tests.conftest import SF_SMALL

from .samples import sample_docs


def plain(rows, columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


def test_rules_agree_with_sql(spark):
    docs = sample_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = quality_rules.judge(docs).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(quality_rules.oracle()).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [d[columns].sort_values("doc_id").astype(object).fillna(-1).to_numpy().tolist() for d in (got, want)]
    assert rows[0] == rows[1]
    assert got.kept.sum() > 100


def test_repeated_words_of_a_text(spark):
    texts = {1: "a b c d e f g h " * 3, 2: "x " * 9, 3: " ".join(map(str, range(50))), 4: "one two three four five six seven eight", 5: None}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.base_counts(docs, ("doc_id",)).collect()}
    want = {}
    for k, t in texts.items():
        w = (t or "").split()
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        want[k] = len({j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 8)})
    assert got == want


def test_sketch_buckets(spark):
    v = [0, 1, 31, 32, 33, 63, 64, 65, 127, 128, 1000, 123_456_789]
    rows = spark.createDataFrame([(x,) for x in v], "v long")
    from pyspark.sql import functions as F

    got = rows.select("v", quality_rules.bucket(F.col("v")).alias("b")).withColumn("low", quality_rules.bucket_low(F.col("b"))).collect()
    for r in got:
        assert r.low <= r.v <= r.low * (1 + 1 / 32)
    assert [r.b for r in sorted(got, key=lambda r: r.v)] == sorted(r.b for r in got)


def der(tag: int, body: bytes) -> bytes:
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda x: bytes([0x80 | len(x)]) + x)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


KEY = der(0x30, der(0x02, b"\0") + b"".join(der(0x02, bytes([1]) + bytes(range(k, k + 40))) for k in range(4)))


def b64url(x: bytes) -> str:
    return base64.urlsafe_b64encode(x).decode().rstrip("=")


def test_base_kinds():
    assert secrets.joined(secrets.scan("my token = 'abcdefABCDEF1' end")) == "assign:3:25"
    assert secrets.joined(secrets.scan("é PassWord:short")) == ""
    # The first match takes the second keyword as its value, so nothing is left that would be long enough.
    assert secrets.scan("token: secret: abcdefghijklmnop") == []
    assert secrets.joined(secrets.scan("token = 0123456789abcdef")) == "assign:0:24,hex:8:24"
    assert secrets.joined(secrets.scan("xAKIAAAAABBBBCCCC12 AKIAAAAABBBBCCCC1 ")) == "access:1:19"
    assert secrets.scan("paſſword = abcdefghijklmnop") == []
    assert secrets.scan(None) == secrets.scan("") == []


def test_confirmed_kinds():
    head, body = b64url(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), b64url(b'{"sub": "1"}')
    good = f"{head}.{body}.c2lnbmF0dXJl"
    assert [s[2] for s in secrets.scan(f"a {good} b")] == ["jwt"]
    assert secrets.scan(f"a {b64url(b'{ not json at all }')}.{body}.c2ln b") == []
    run = base64.b64encode(KEY).decode()
    lines = "\n".join(run[i : i + 64] for i in range(0, len(run), 64))
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----"
    assert "pem" in [s[2] for s in secrets.scan(pem)]
    assert "pem" not in [s[2] for s in secrets.scan(pem.replace(run[:8], "AAAAAAAA"))]
    assert [s[2] for s in secrets.scan(f"k {run} k")] == ["der64"]
    assert [s[2] for s in secrets.scan(f"k {base64.b64encode(KEY[:-1]).decode()} k")] == []
    assert sorted(s[2] for s in secrets.scan(KEY.hex())) == ["derhex", "hex"]
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
    assert [s[2] for s in secrets.scan("ssh-ed25519 " + base64.b64encode(ssh).decode())] == ["ssh"]



def wrap(run: str, end: str = "\n", width: int = 64) -> str:
    return end.join(run[i : i + width] for i in range(0, len(run), width))


def test_keys_as_they_are_found_in_files():
    run, ssh = base64.b64encode(KEY).decode(), b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"

    def kinds(text):
        return [s[2] for s in secrets.scan(text)]

    for eol in ("\\n", "\\r\\n", "\\\\n", "\r\n"):
        pem = f"{begin}{eol}{wrap(run, eol)}{eol}{end}"
        text = '{"private_key": "' + pem + eol + '"}'
        assert (text.index(pem), text.index(pem) + len(pem), "pem") in secrets.scan(text)
        assert secrets.scan(f"k {wrap(run, eol)} k") == [(2, 2 + len(wrap(run, eol)), "der64")]
    assert "pem" in kinds(f"{begin}\nComment: my key\n\n{wrap(run)}\n{end}")
    sealed = f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{wrap(base64.b64encode(bytes(range(160))).decode())}"
    assert "pem" in kinds(f"{begin}\n{sealed}\n{end}")
    assert "pem" in kinds(f"{begin}\n{sealed}\n{end}".replace("\n", "\\n"))
    assert "pem" not in kinds(f"{begin}\n{sealed.replace('Proc-Type', 'x').replace('DEK-Info', 'y')}\n{end}")
    assert kinds(f"{'q' * 70}\n{wrap(run)}\n{wrap(run)}\nand then") == ["der64", "der64"]
    assert kinds(f"x\\n{run}\\n") == ["der64"]
    assert kinds(wrap(base64.b64encode(KEY[:-1]).decode())) == []
    assert kinds(f"-----BEGIN CERTIFICATE-----\n{wrap(run)}\n-----END CERTIFICATE-----") == []
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(KEY.hex()))
    assert "derhex" in kinds(f"k {mixed} k")
    assert "derhex" in kinds(f"k {KEY.hex()}AB k")
    assert "ssh" in kinds(f"k {ssh.hex()} k") and "ssh" in kinds(f"k {ssh.hex().upper()} k")
    for text in ("\n" * 50_000, ("A" * 64 + "\n") * 20_000, ("MA" * 32 + "\n") * 5_000, "\\n" * 50_000):
        assert secrets.scan(begin + text) == []


def test_masking(spark):
    docs = sample_docs(spark)
    got = secrets.mask_documents(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    for r in got.collect():
        assert not [s for s in secrets.scan(r.text) if s[2] in ("hex", "access")]
    assert secrets.redact("ab token=abcdefghijkl cd", secrets.scan("ab token=abcdefghijkl cd")) == "ab [SECRET] cd"
    assert secrets.redact("abcdefgh", [(1, 3, "hex"), (2, 4, "assign"), (6, 7, "hex")], "_") == "a_ef_h"


def test_scan_of_documents(spark):
    docs = sample_docs(spark).withColumnRenamed("n_chars", "spans")
    got = secrets.scan_documents(docs)
    assert got.count() == docs.count()
    assert got.where("spans != '' ").count() > 0
    assert secrets.scan_documents(docs.where("false")).count() == 0


@pytest.mark.parametrize("empty", [True])
def test_rules_on_an_empty_table(spark, empty):
    assert quality_rules.judge(spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")).count() == 0


def test_fences_come_from_the_sketches(spark):
    """The same text is kept among its like and goes where it stands out; no fixed cutoff decides."""
    words = [f"word{i}" for i in range(100)]
    prose = [(i, " ".join(words[(i * 7 + j * 13) % 100] for j in range(60)), "en", "prose") for i in range(200)]
    code = [(1000 + i, " ".join((words[(i * 7 + j * 13) % 100][:-1] + ("$" if j % (3 + i % 3) else "x")) for j in range(60)), "en", "code") for i in range(200)]
    stray = [(5000, code[3][1], "en", "prose"), (5001, prose[3][1], "en", "code")]
    docs = spark.createDataFrame(prose + code + stray, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert not got[5000].kept and got[5001].kept
    assert sum(r.kept for k, r in got.items() if k < 5000) == 400
    assert got[0].max_symbols <= 2 and got[1000].max_symbols > 700
    # One text in ten may be junk: the fence stays with the others.
    mixed = spark.createDataFrame(prose + [(k + 8000, t, "en", "prose") for k, t, *_ in code[:18]], docs.schema)
    kept = {r.doc_id for r in quality_rules.judge(mixed).where("kept").collect()}
    assert kept == {k for k, *_ in prose}


def test_base_spans_equal_plain_patterns(spark):
    """Counts, offsets and digest of the base kinds, recomputed by plain patterns over every document."""
    import hashlib
    import re

    kinds = {
        "assign": (re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    }
    odd = [(1, "é password = 'abcdefghijkl' AKIA" + "A1" * 9 + " " + "0af" * 9), (2, "Api_Key:short token==" + "x" * 20), (3, "AKIAAKIA" + "Z" * 12 + "deadbeef" * 2), (4, None), (5, "")]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(k + 10**6, t) for k, t in odd], docs.schema))
    got = {r.doc_id: r for r in secrets.scan_documents(docs).collect()}
    found = 0
    for r in docs.collect():
        spans = [(m.start(), i, m.end(), kind) for i, (kind, (pattern, ok)) in enumerate(kinds.items()) for m in pattern.finditer(r.text or "") if ok(m)]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        x = got[r.doc_id]
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(s[3] == kind for s in spans) for kind in kinds], r.doc_id
        assert x.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(x.spans.split(","))
        found += len(spans)
    assert found > 20
