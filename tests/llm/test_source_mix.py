"""The source mix against a direct version, and its SQL."""

import hashlib
import re
from collections import defaultdict

import pytest
from check_oracle import compare

from blockpulse.llm import source_mix
from blockpulse.llm.queries import OP5_SQL, QUERIES


def slow_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s: most * sizes[s] for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return full | share
        full |= over


def slow_mix(rows):
    def number(name):
        return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)

    sizes, docs, of_hash = defaultdict(int), defaultdict(list), defaultdict(list)
    for row_id, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        name = str(row_id) if row_id is not None else "-" + hashlib.md5((text or "").encode()).hexdigest()
        sizes[source] += size
        of_hash[number(name)].append((source, size, row_id))
    for h, same in of_hash.items():
        same.sort(key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1], r[2] is not None, r[2] or 0))
        for again, (source, size, row_id) in enumerate(same):
            docs[source].append((number(f"{h}#{again}") if again else h, size, row_id))
    targets, out = slow_targets(sizes), []
    for source, own in docs.items():
        copies = int(targets[source] // sizes[source]) if sizes[source] else 0
        budget, spent, taken = targets[source] - copies * sizes[source], 0, set()
        by_hash = defaultdict(int)
        for h, size, _ in own:
            by_hash[h] += size
        for h in sorted(by_hash):
            if budget <= 0 or 2 * (budget - spent) < by_hash[h]:
                break
            taken.add(h)
            spent += by_hash[h]
        out += [(i, size, sizes[source], targets[source], copies + (h in taken), size * (copies + (h in taken))) for h, size, i in own]
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[4:] == b[4:] and a[3] == pytest.approx(b[3], rel=1e-12)


def test_query(spark, sf, oracle):
    assert compare(QUERIES["op5_source_mix"](spark, sf), oracle, OP5_SQL) is None
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    want = slow_mix([tuple(r) for r in docs.collect()])
    same(source_mix.taken_words(docs).collect(), want)


def test_taken_is_near_the_target(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', cast(pmod(hash(id), 50) as int)) AS text", "if(id % 3 = 0, 'a', concat('s', id % 40)) AS source")
    rows = source_mix.taken_words(df).collect()
    targets, taken = {}, defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3
    by_id = {r.id: r for r in rows}
    for r in df.select("doc_id", "source").collect():
        targets[r.source] = by_id[r.doc_id].target
        taken[r.source] += by_id[r.doc_id].taken
    assert all(abs(taken[s] - t) <= 25 for s, t in targets.items())
    assert sum(targets.values()) == pytest.approx(sum(r.size for r in rows))


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (None, "x y z", "b"), (None, None, "b"), (4, "w " * 5000, "b"), (4, "w " * 5000, "b"),
            (5, "z", "é"), (6, "z", "z"), (6, "z", "z"), (7, " ", "void")]
    df = spark.createDataFrame([(*r, 0, "t") for r in rows], "doc_id long, text string, source string, size int, _row string")
    same(source_mix.taken_words(df).collect(), slow_mix(rows))
    mixed = source_mix.mix(df)
    assert mixed.columns == df.columns
    want = sorted(((i, copies) for i, _, _, _, copies, _ in slow_mix(rows) if copies), key=str)
    counts = defaultdict(int)
    for r in mixed.collect():
        counts[r.doc_id] += 1
    total = defaultdict(int)
    for i, copies in want:
        total[i] += copies
    assert counts == total
    empty = df.where("doc_id > 100")
    assert source_mix.taken_words(empty).collect() == [] and source_mix.mix(empty).collect() == []


def test_rows_of_one_id_are_taken_one_by_one(spark, tmp_path):
    rows = [(7, "w " * 50, "a", 1)] * 60 + [(8, "w " * 80, "a", 2), (9, "w " * 700, "b", 3), (7, "w " * 9, "b", 4), (7, "w " * 9, None, 5)] + [(None, "x y", "b", k % 2) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _row int").repartition(6)
    want = slow_mix([r[:3] for r in rows])
    got = source_mix.taken_words(df).collect()
    same(got, want)
    taken, target = sum(r.taken for r in got if r.source_size == 3080), {r.target for r in got if r.source_size == 3080}
    assert abs(taken - target.pop()) <= 80
    df.write.parquet(f"{tmp_path}/documents.parquet")
    from check_oracle import oracle_connection

    con = oracle_connection("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(QUERIES["op5_source_mix"](spark, str(tmp_path)), con, OP5_SQL) is None
    mixed = [sorted(map(str, source_mix.mix(f).collect())) for f in (df, df.repartition(3))]
    assert mixed[0] == mixed[1]
    by_id = defaultdict(int)
    for i, _, _, _, copies, _ in want:
        by_id[str(i)] += copies
    found = defaultdict(int)
    for r in source_mix.mix(df).collect():
        found[str(r.doc_id)] += 1
    assert found == {i: n for i, n in by_id.items() if n}


def test_a_source_that_is_one_repeated_row(spark):
    rows = [(1, "w " * 10, "a")] * 900 + [(k, "w " * 10, "b") for k in range(10, 1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(16)
    got = source_mix.taken_words(df).collect()
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10
