"""Secret spans against scanning every text, and the derived trigram queries."""

import hashlib
import random
import re

import pytest

from blockpulse.llm import secret_scan
from blockpulse.llm.queries import QUERIES
from blockpulse.llm.secret_scan import RULES, Scanner, both, either, trigram_query

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def slow_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def matches(query, text):
    if query is True:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(matches(q, text) for q in query[1])


def test_queries():
    assert trigram_query("AKIA[A-Z0-9]+") == both("aki", "kia")
    assert trigram_query("[0-9a-f]+") is True
    assert trigram_query("(abc|xyz)") == either("abc", "xyz")
    assert trigram_query("ab?cd") == either("acd", both("abc", "bcd"))
    assert trigram_query("a.*b") is True and trigram_query("(?:abc)*") is True
    assert trigram_query(RULES[0].pattern)[0] == "or"


@pytest.mark.parametrize("pattern", ["ab+cde", "x[yz]w[0-9]{2}", "(foo|ba[rz])qux?", "(?i:HeLLo) w", "a{3,}b", "(ab|cd){2}e", "k(?=ey)ey", "a{9}"])
def test_query_never_misses(pattern):
    rng, rule, query = random.Random(4), re.compile(pattern), trigram_query(pattern)
    alphabet = "abcdefoqruxyzwklhHeELo 0123"
    for _ in range(20_000):
        text = "".join(rng.choices(alphabet, k=8))
        if rule.search(text):
            assert matches(query, text.lower())
    for text in ("abbcde", "xyw12", "foouqu foqux fooqu barqux bazqu", "hEllO w", "aaaab", "abcde cdabe", "key", "a" * 9):
        if rule.search(text):
            assert matches(query, text.lower())


TEXTS = ["", None, "token=abcde", "token=abcdef", "TOKEN : 'abc.def/ghi'", "paSSwd='' password=secret=token=abcdefgh", "ſecret=abcdefgh toKen=abcdefgh",
         "AKIA" + "Z" * 16, "AKIA" + "Z" * 15, "AKIAAKIA" + "0" * 12, "é" * 5 + "0123456789abcdef" * 2, "f" * 23, "api_key=f00" * 3, "apikey:" + "a" * 30,
         "x" * 100_000 + " secret = " + "0" * 24]


def test_fixed_texts():
    got = Scanner(RULES).spans([t or "" for t in TEXTS])
    assert got == [slow_spans(t) for t in TEXTS]


def test_random_texts(monkeypatch):
    rng = random.Random(6)
    parts = ["token", "=", "Secret", ":", " ", "'", "AKIA", "0A", "abc", "def0123", "é", "api", "_", "key", "passwd", "word", "pass", "ff00", "\0"]
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 5, 40, 200]))) for _ in range(2000)]
    assert Scanner(RULES).spans(texts) == [slow_spans(t) for t in texts]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in got.values())
    for doc in docs:
        spans, row = slow_spans(doc.text), got[doc.doc_id]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.spans == text and row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex"))


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "SEGMENT_BYTES", 40)
    rows = [(i if i % 3 else None, t, "t", len(t) if t is not None else None) for i, t in enumerate([*TEXTS, "token=abcdef", "token=abcdef"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = sorted((r.id is None, r.id or 0, [tuple(s) for s in r.spans]) for r in secret_scan.scan(df).collect())
    assert got == sorted((i is None, i or 0, slow_spans(t)) for i, t, _, _ in rows)
    clean = secret_scan.redact(df, size_col="n_chars")
    assert clean.columns == df.columns and clean.count() == len(rows)
    for r in clean.collect():
        assert slow_spans(r.text) == [] and (r.n_chars == len(r.text) if r.text is not None else r.n_chars is None)
    assert sum(r.text is None for r in clean.collect()) == 1
    empty = df.where("doc_id > 100")
    assert secret_scan.scan(empty).collect() == [] and secret_scan.redact(empty).collect() == []


def test_blanked():
    assert secret_scan.blanked("ab token=0011 cd", [("assign", 3, 13), ("hex", 9, 13)], "#") == "ab # cd"
