"""Secret spans against a plain reading of the rules."""

import hashlib
import re

from conftest import SMALL

from tripweave.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEY40 = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def told(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


TEXTS = [
    None,
    "",
    "no secrets here",
    "token=ab token=token:abcdefg é password : 'hunter22x'",
    "😀é api_key=" + "a1" * 20 + " AKIA" + "A" * 16 + " AKIA" + "B" * 15,
    "AKIAAKIA" + "C" * 20,
    "secret = x\nsecret=abcdef" + "0" * 30,
    "token=abcdef " * 3000,
    "pasſword=abcdefg toKen=abcdefg",
]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'x' as Text", "1 as row")
    got = sorted(map(tuple, secrets.secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()), key=str)
    expected = []
    for i, t in rows:
        spans = base(t)
        counts = [sum(s[3] == kind for s in spans) for kind in ("assign", "access", "hex")]
        expected.append((i, *counts, hashlib.sha256(told(spans).encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    for r in docs.collect():
        spans = base(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(told(spans).encode()).hexdigest()
        kept = [s for s in got[r.doc_id].spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(kept) == told(spans)


def linked(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    return [s.split(":")[0] for s in secrets.secrets(docs).first().spans.split(",") if s]


def test_weak_parts_need_their_complements(spark):
    access = "AKIA" + "A" * 16
    assert linked(spark, f"a key {KEY40} alone") == []
    assert linked(spark, f"login: alice and https://db.example.org/x") == []
    assert linked(spark, f"id {access} key {KEY40}") == ["access", "key"]
    assert linked(spark, f"id {access}\n\nkey {KEY40}") == ["access"]
    assert linked(spark, f"id {access} {'x ' * 300} key {KEY40}") == ["access"]
    assert linked(spark, f"https://db.example.org/x login: alice password=hunter22") == ["endpoint", "login", "assign"]
    assert linked(spark, f"https://db.example.org/x password=hunter22") == ["assign"]


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "say token=abcdefgh now", 3), (2, "clean text", 4), (3, None, 5), (4, f"é AKIA{'A' * 16} {KEY40}!", 6)],
        "doc_id bigint, text string, n bigint",
    )
    got = {r.doc_id: (r.text, r.n) for r in secrets.redact(docs).collect()}
    assert got == {1: ("say [SECRET] now", 3), 2: ("clean text", 4), 3: (None, 5), 4: ("é [SECRET] [SECRET]!", 6)}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert secrets.secrets(docs).count() == 0 and secrets.redact(docs).count() == 0
