"""Exact duplicates by the cuckoo-filter index against direct versions."""

import hashlib
import random

from pyspark.sql import functions as F

from blockpulse.llm import cuckoo_dedup as cd
from blockpulse.llm.queries import QUERIES
from blockpulse.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def slow_copies(rows):
    """(id, text) -> {text: (keep_id, size)}"""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def digest(text):
    return hashlib.sha256((text or "").encode()).digest()


def check(spark, rows):
    got = cd.exact_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    want = slow_copies(rows)
    by_digest = {digest(t): v for t, v in want.items()}
    assert sorted(((r.id, bytes(r.digest)) for r in got), key=str) == sorted(((i, digest(t)) for i, t in rows), key=str)
    assert all((r.keep_id, r.group_size) == by_digest[bytes(r.digest)] for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and all(r.id == r.keep_id for r in kept)
    assert all(r.n_bytes == 0 for r in got if bytes(r.digest) == digest(""))


def test_query_matches_direct_version(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = slow_copies(docs)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in QUERIES["op11_cuckoo_dedup"](spark, sf).collect()}
    assert got == {i: (*want[t or ""], want[t or ""][0] == i, digest(t).hex()) for i, t in docs}


def test_edge_rows(spark):
    check(spark, [(1, "a"), (2, "a"), (2, "a"), (2, "b"), (None, "a"), (None, "c"), (None, "c"), (5, None), (6, ""), (-7, "d"), (7, "A"), (8, "x" * 3_000_000), (9, "x" * 3_000_000), (10, "é"), (11, "é")])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cd.exact_copies(empty).collect() == [] and cd.drop_copies(empty).collect() == []


def test_one_text_in_most_rows_and_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(cd, "_HELD", 50)
    monkeypatch.setattr(cd, "SHARD_KEYS", 100)
    rng = random.Random(1)
    rows = [(i, "same" if i % 3 else f"text {rng.randrange(400)}") for i in range(3000)]
    check(spark, rows)
    got = cd.exact_copies(spark.createDataFrame(rows, SCHEMA).repartition(40)).where("kept").select("id").collect()
    assert len(got) == len(slow_copies(rows))


def test_filter_grows_and_deletes():
    f, live = cd.Filter(2), {}
    rng = random.Random(4)
    for i in range(6000):
        key = digest(str(i))
        f.add([key, 1, 1, i, i])
        live[key] = i
        if i % 3 == 0:
            gone = rng.choice(list(live))
            assert f.remove(gone) and not f.remove(gone)
            del live[gone]
    assert f.resizes >= 8 and f.buckets >= 1024
    assert all(f.content[f.find(k)][3] == i for k, i in live.items())
    assert sum(c is not None for c in f.content) == len(live) == sum(p > 0 for p in f.prints)
    assert all(f.find(digest(f"other {i}")) is None for i in range(3000))
    again = cd.Filter.stored(f.table(0))
    assert (again.prints, again.content, again.buckets) == (f.prints, f.content, f.buckets)


def test_hits_are_verified_against_the_content():
    one = b"\x00\x05" + bytes(8) + b"a" * 22
    two = b"\x00\x05" + bytes(8) + b"b" * 22  # same print, same buckets
    f = cd.Filter()
    f.add([one, 1, 1, 1, 1])
    assert f.find(two) is None and f.false_hits == 1
    f.add([two, 1, 1, 2, 2])
    assert f.find(one) != f.find(two) and f.remove(one) and f.find(two) is not None


def test_prints_that_collide_often_make_the_filter_grow():
    # Ten digests of one print and one low bucket number: eight slots at most until the buckets part them.
    keys = [b"\x00\x05" + (64 * i).to_bytes(8, "big") + bytes([i]) * 22 for i in range(10)]
    f = cd.Filter()
    for i, k in enumerate(keys):
        f.add([k, 1, 1, i, i])
    assert f.resizes and [f.content[f.find(k)][3] for k in keys] == list(range(10))


def test_batches_deletions_and_returns(spark):
    scratch = Scratch(spark, "test-cuckoo")

    def batch(rows, first):
        df = spark.createDataFrame([(first + k, i, t) for k, (i, t) in enumerate(rows)], "row long, doc_id long, text string")
        return cd.digests(df, row=F.col("row"))

    one = cd.build(batch([(1, "a"), (2, "b"), (3, "a")], 0), scratch, shard_keys=1)
    two = one.inserted(batch([(9, "b"), (4, "c")], 10))
    gone = two.deleted(batch([(0, "a"), (0, "never seen")], 0))
    back = gone.inserted(batch([(5, "a")], 20))

    def state(index):
        return {(bytes(r.digest), r.copies, r.keep_id) for r in index.table.collect()}

    assert state(one) == {(digest("a"), 2, 3), (digest("b"), 1, 2)}
    assert state(two) == {(digest("a"), 2, 3), (digest("b"), 2, 9), (digest("c"), 1, 4)}
    assert state(gone) == {(digest("b"), 2, 9), (digest("c"), 1, 4)}
    assert state(back) == state(gone) | {(digest("a"), 1, 5)}
    asked = batch([(1, "a"), (1, "c")], 30)
    assert [r.keep_id for r in gone.found(asked).collect()] == [4]


def test_drop_copies_keeps_columns_of_any_name(spark):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (2, "a", "y", 2), (3, "b", None, None), (None, "c", "z", 3), (4, "B", "w", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, `_stays` long")
    got = sorted(map(tuple, cd.drop_copies(docs).collect()), key=str)
    assert got == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)
    lower = cd.drop_copies(docs, normalise=F.lower)
    assert sorted(r.text for r in lower.collect()) == ["B", "a", "c"]
