"""Nearest neighbours and near-duplicate vectors against brute force."""

import numpy as np
import pytest

from blockpulse.llm import cell_dedup, partition_ann
from blockpulse.llm.queries import QUERIES
from test_components import expected


def valid(vectors):
    return {i: np.array(v, float) for i, v in vectors if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}


def slow_search(vectors, queries, k=10):
    ids = np.array(sorted(vectors))
    every = np.stack([vectors[i] for i in ids])
    out = {}
    for q in queries:
        score = np.sqrt(((every - vectors[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def slow_groups(vectors, cosine=0.9):
    ids = sorted(vectors)
    u = np.stack([vectors[i] for i in ids])
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    close = u @ u.T >= cosine
    np.fill_diagonal(close, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close)))]
    return {i: int(n) for i, n in zip(ids, close.sum(axis=1))}, expected(ids, links)


def table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    return df, valid([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()])


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_search_query(spark):
    df, vectors = table(spark, "/root/testdata/sf0.1")
    got = found(QUERIES["op1_partition_ann"](spark, "/root/testdata/sf0.1"))
    want = slow_search(vectors, [i for i in vectors if i % 100 == 0])
    assert set(got) == set(want) and all(len(got[q]) == 10 for q in want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (p[1], p[0]))
        for i, score in near:
            assert score == pytest.approx(np.sqrt(((vectors[q] - vectors[i]) ** 2).sum()), rel=1e-14)


def test_search_prunes_where_vectors_cluster(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16)) * 6
    x = np.concatenate([c + rng.normal(size=(60, 16)) for c in centres])
    router = partition_ann.learn(x, 8, 10, 0.97)
    routes = router.routes(x)
    assert routes.sum(axis=1).mean() < 4
    part = np.bincount(router.probabilities(x).argmax(axis=1), minlength=8) / len(x)
    assert part.max() < 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for block in (64, 4096):
        partition_ann.BLOCK, keep = block, partition_ann.BLOCK
        got = found(partition_ann.search(df, partition_ann.F.col("id") % 50 == 0, parts=8))
        partition_ann.BLOCK = keep
        want = slow_search(dict(enumerate(x)), range(0, len(x), 50))
        assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_partitions_of_partitions(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 12)) * 6
    x = np.concatenate([c + rng.normal(size=(80, 12)) for c in centres])[rng.permutation(4800)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000 + i, x[5].tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(partition_ann, "LEAF", 100)
    monkeypatch.setattr(partition_ann, "BLOCK", 64)
    assert partition_ann.fans(5500, 6) == [4, 4, 4] and partition_ann.fans(5500, 100) == [100] and partition_ann.fans(5500, 1) == [1]
    got = found(partition_ann.search(df, partition_ann.F.col("id") % 60 == 0, parts=6))
    vectors = {i: np.array(v) for i, v in rows}
    want = slow_search(vectors, [i for i in vectors if i % 60 == 0])
    assert set(got) == set(want) and all(len(near) == 10 for near in got.values())
    assert sum(len({s for _, s in got[q]} & {s for _, s in want[q]}) for q in want) >= 0.9 * sum(len({s for _, s in want[q]}) for q in want)


def test_balanced_parts():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 8))
    part = partition_ann.balanced_parts(partition_ann.nearest(x, 8, np.arange(1000)), 8, rng)
    assert (np.bincount(part, minlength=8) == 125).all()


ODD = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, []), (8, [1.0, 2.0, 3.0]),
       (9, [2.0, 0.0]), (10, [0.0, 1.0]), (11, [1.0, 0.0]), (12, [1e-200, 0.0]), (13, [0.9, -0.1])]


def test_search_edges(spark):
    rows = [(i, v, 0.0) for i, v in [*ODD, (9, [2.0, 0.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0])]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = found(partition_ann.search(df, partition_ann.F.col("id") < 3))
    ok = {i: v for i, v in valid(ODD).items() if len(v) == 2}
    assert got == slow_search(ok, [0, 1])
    assert partition_ann.search(df.where("vec_id > 50"), partition_ann.F.col("id") >= 0).collect() == []


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_groups_query(spark, size):
    df, vectors = table(spark, f"/root/testdata/{size}")
    got = {r.vec_id: r for r in QUERIES["op7_cell_dedup"](spark, f"/root/testdata/{size}").collect()}
    links, groups = slow_groups(vectors)
    assert {i: r.n_links for i, r in got.items()} == links
    assert {i: r.component_id for i, r in got.items()} == groups
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_groups_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(cell_dedup, "BLOCK", 40)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 24))
    x = np.concatenate([base, base[:20] + 0.05 * rng.normal(size=(20, 24)), base[0] + 0.1 * rng.normal(size=(300, 24)), base[1] + 0.45 * rng.normal(size=(150, 24)), base[:9]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    links, groups = slow_groups(dict(enumerate(x)))
    got = {r.id: (r.n_links, r.component_id) for r in cell_dedup.near_duplicates(df).collect()}
    assert got == {i: (links[i], groups[i]) for i in links}


@pytest.mark.parametrize("split, most", [(50, 4), (300, 2), (1, 3)])
def test_groups_in_cells_that_are_cut_again(spark, monkeypatch, split, most):
    monkeypatch.setattr(cell_dedup, "BLOCK", 32)
    monkeypatch.setattr(cell_dedup, "SPLIT", split)
    monkeypatch.setattr(cell_dedup, "MOST_CELLS", most)
    rng = np.random.default_rng(split)
    base = rng.normal(size=(150, 10))
    x = np.concatenate([base, base + 0.3 * rng.normal(size=base.shape), base[0] + 0.2 * rng.normal(size=(400, 10)), base[:30], base + 0.25 * rng.normal(size=base.shape)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None)], "vec_id long, embedding array<double>")
    links, groups = slow_groups(dict(enumerate(x)))
    got = {r.id: (r.n_links, r.component_id) for r in cell_dedup.near_duplicates(df, sample=120).collect()}
    assert got == {i: (links[i], groups[i]) for i in links} | {9000: (0, 9000)}


def test_groups_edges(spark):
    rows = [(i, v, 0) for i, v in [*ODD, (10, [0.0, 1.0]), (None, [1.0, 0.0])]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in cell_dedup.near_duplicates(df).collect()), key=str)
    group = [0, 1, 9, 11, 12, 13]
    alone = [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8)] + [(None, 0, None, True)] + [(10, 1, 10, True)] * 2
    assert got == sorted([(i, 5, 0, i == 0) for i in group] + alone, key=str)
    assert cell_dedup.near_duplicates(df.where("vec_id > 50")).collect() == []


def test_groups_in_few_directions(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(1500, 16))
    directions = np.linalg.qr(rng.normal(size=(256, 16)))[0]
    x = np.concatenate([base, base + 0.42 * rng.normal(size=base.shape)]) @ directions.T
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    links, groups = slow_groups(dict(enumerate(x)))
    got = {r.id: (r.n_links, r.component_id) for r in cell_dedup.near_duplicates(df).collect()}
    assert got == {i: (links[i], groups[i]) for i in links}


def test_visits_leave_out_no_partner():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(500, 3)) @ rng.normal(size=(3, 40))
    u = cell_dedup.unit(np.concatenate([base, base + rng.normal(size=base.shape) * rng.uniform(0, 1, (500, 1))]))
    for cosine in (0.5, 0.9, 0.99):
        centres = cell_dedup.spherical_kmeans(u, 40)
        near = u @ centres.T
        home, angle = near.argmax(axis=1), np.arccos(np.clip(near.max(axis=1), -1, 1))
        angles = np.array([[f(angle[home == c], initial=x) for c in range(40)] for f, x in ((np.min, np.inf), (np.max, -np.inf))])
        looks = cell_dedup.visits(u, home, centres, angles, cosine)
        a, b = np.nonzero(u @ u.T >= cosine)
        assert looks[a, home[b]].all()
        if cosine == 0.99:
            assert looks.mean() < 0.5
    parts = cell_dedup.regions(centres, np.bincount(home, minlength=40), 100)
    assert sorted(np.concatenate(parts)) == list(range(40))


def test_two_lengths(spark):
    rng = np.random.default_rng(9)
    x = [rng.normal(size=n) for n in (8, 5) for _ in range(120 if n == 8 else 80)]
    x += [x[i] + 0.05 * rng.normal(size=len(x[i])) for i in range(100, 150)] + [x[i] for i in range(110, 130)] + [np.ones(3)]
    vectors = dict(enumerate(x))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    want_links, want_groups, want_near = {}, {}, {}
    for n in (3, 5, 8):
        same = {i: v for i, v in vectors.items() if len(v) == n}
        links, groups = slow_groups(same)
        want_links |= links
        want_groups |= groups
        want_near |= slow_search(same, [i for i in same if i % 10 == 0])
    got = {r.id: r for r in cell_dedup.near_duplicates(df).collect()}
    assert {i: r.n_links for i, r in got.items()} == want_links and {i: r.component_id for i, r in got.items()} == want_groups
    near = found(partition_ann.search(df, partition_ann.F.col("id") % 10 == 0, parts=1))
    assert {q: [i for i, _ in v] for q, v in near.items()} == {q: [i for i, _ in v] for q, v in want_near.items() if v}
