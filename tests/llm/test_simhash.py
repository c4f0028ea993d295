"""SimHash near-duplicates against a brute-force version."""

from itertools import combinations

import pytest
import xxhash

from blockpulse.llm import simhash
from blockpulse.llm.queries import QUERIES
from blockpulse.llm.scratch import Scratch


def slow_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=2):
    label = {p: p for p in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(prints, 2):
        if bin(a ^ b).count("1") <= distance:
            label[root(a)] = root(b)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("text", ["", "one", "one two", "One TWO three", "a b c d\te\nf\x0bg", "é È ß ü a b c d", None, "x " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_query_matches_brute_force(spark, sf):
    got = QUERIES["op8_simhash_near_dedup"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    roots = slow_components(sorted(set(prints.values())))
    smallest = {}
    for doc_id, p in prints.items():
        smallest[roots[p]] = min(doc_id, smallest.get(roots[p], doc_id))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{p:016x}", smallest[roots[p]]) for d, p in prints.items()}
    assert len(got) == len(docs)


def test_large_bucket_keeps_every_link(spark, monkeypatch):
    base = 0x0123_4567_89AB_CDEF
    prints = {base} | {base ^ (1 << i) for i in range(20)} | {base ^ (3 << i) for i in range(30, 60)} | {base ^ (7 << 10)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = slow_components(sorted(prints))
    for limit in (1, 1000):
        monkeypatch.setattr(simhash, "PAIR_BUCKET", limit)
        links = simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"), Scratch(spark, "t")).collect()
        pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in links}
        assert all(bin(a ^ b).count("1") <= 2 for a, b in pairs)
        label = {p: p for p in prints}
        for _ in prints:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        assert len(set(label.values())) == len(set(want.values()))


EDGE = "doc_id long, text string, fp string, id long, _kept string"


def test_edge_rows(spark):
    rows = [(5, None, "x", 1, None), (3, "", None, None, "k"), (None, " ", "y", 2, "k"), (9, "a b c d", None, 0, None),
            (9, "a b c d", None, 0, None), (7, "A  B c\nD", None, 0, None), (None, "only here", None, 0, None), (None, "only here", None, 0, None)]
    df = spark.createDataFrame(rows, EDGE)
    got = sorted(((r.id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (None, 3), (9, 7), (9, 7), (7, 7), (None, None), (None, None)], key=str)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, ""), (7, "A  B c\nD"), (None, "only here")], key=str)


def test_repeated_kept_row_stays_once(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert [tuple(r) for r in simhash.keep_first(df).collect()] == [(1, "a b c")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_first(df).collect() == []


def slow_keep(rows, columns):
    """The row that stays of each class; `rows` are tuples with doc_id and text first."""
    import hashlib
    import json

    prints = {r[1]: slow_fingerprint(r[1]) for r in rows}
    roots, kept = slow_components(sorted(set(prints.values()))), {}
    for r in rows:
        whole = json.dumps({c: v for c, v in zip(columns, r) if v is not None}, separators=(",", ":"), ensure_ascii=False)
        order = (r[0] is None, r[0] or 0, hashlib.md5(whole.encode()).digest())
        root = roots[prints[r[1]]]
        kept[root] = min(kept.get(root, (order, r)), (order, r), key=lambda x: x[0])
    return sorted((r for _, r in kept.values()), key=str)


def test_keep_first_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in ("one", "two", "three"))
    columns = ["doc_id", "text", "_rows", "_kept", "node", "mark", "n", "doc", "fp"]
    tail = ("x", 1, 2, "m", 3, "d", 4)
    rows = [
        (5, a, *tail), (5, b, *tail),  # one id, unlike texts: both stay
        (3, c, *tail), (5, c, *tail),  # a copy whose id other rows keep
        (8, "four words are here", *tail), (8, "four words are here", *tail),  # equal rows
        (9, "five words are not here", *tail), (9, "five words are not here", "y", *tail[1:]), (9, "five words are not here", "y", *tail[1:]),  # equal but for a column
        (None, a, *tail), (None, "six words are found in here", *tail), (None, "six words are found in here", *tail), (None, "six words are found in here", None, *tail[1:]),
        (1, None, *tail), (2, "", *tail), (None, "", *tail), (-4, "seven", *tail),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rows string, _kept long, node long, mark string, n int, doc string, fp long")
    runs = [sorted((tuple(r) for r in simhash.keep_first(f).collect()), key=str) for f in (df, df.repartition(5), df.repartition(2, "doc_id"))]
    assert runs[0] == runs[1] == runs[2] == slow_keep(rows, columns)
    assert {r[0] for r in runs[0] if r[1] in (a, b)} == {5} and len([r for r in runs[0] if r[0] == 5]) == 2
    assert [r[0] for r in runs[0] if r[1] == c] == [3]
