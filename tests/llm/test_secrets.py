"""Secret scans against plain regular expressions."""

import hashlib
import random
import re
import string
import zlib

from pyspark.sql import functions as F

from mediamix.llm import secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def base(spans):
    return [s for s in spans if s[0] in secrets.BASE]


def checked(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secrets.BASE62[d] + digits
    return prefix + body + digits


def test_random_texts_equal_brute_force():
    rng = random.Random(2)
    bits = ["password", "PassWd", "secret", "toKEN", "api_key", "APIkey", "Key", "ſecret", "=", ":", " ", "  ", '"', "'", "abc123", "x", "é", "AKIA", "AKIA" + "A1" * 9, "0123456789abcdef", "deadbeef", "\n", "😀", "İ", "A", "==", "-"]
    scanner = secrets.Scanner()
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        assert base(scanner.spans(text)) == brute(text), repr(text)


def test_small_table(spark, docs):
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in secrets.scan(docs(texts), keep=["doc_id"]).select("doc_id", "secrets.*").collect()}
    assert sum(len(brute(t)) for _, t in texts) > 3
    for key, text in texts:
        spans = brute(text)
        assert (got[key].n_assign, got[key].n_access, got[key].n_hex) == tuple(sum(s[0] == k for s in spans) for k in secrets.BASE)
        assert got[key].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_checksums_and_structure():
    scanner, body = secrets.Scanner(), (string.ascii_letters + string.digits)[7:37]
    good, npm = checked("ghp_", body), checked("npm_", body)
    bad = good[:-1] + ("a" if good[-1] != "a" else "b")
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc_-123"
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----"
    text = f"ü {good} {bad} {npm} {jwt} eyJhbGci.eyJ.x {key}"
    found = [(k, text[a:b]) for k, a, b in scanner.spans(text)]
    assert found == [("github", good), ("npm", npm), ("jwt", jwt), ("private_key", key)]


def test_redaction_and_edges(spark, docs):
    rows = [(1, None), (2, ""), (None, 'x token = "abcdef0123456789abcdef0123" y'), (3, "clean"), (3, "clean"), (4, "eyJ" * 300_000)]
    more = docs(rows).withColumn("secrets", F.lit("mine")).withColumn("spans", F.lit(0))
    out = secrets.redact(more)
    assert out.columns == more.columns
    assert sorted((r.doc_id or 0, r.text, r.secrets) for r in out.collect() if r.doc_id != 4) == sorted([(1, None, "mine"), (2, "", "mine"), (0, 'x [ASSIGN]" y', "mine"), (3, "clean", "mine"), (3, "clean", "mine")], key=lambda r: r[0])
    assert secrets.scan(docs([])).count() == 0
