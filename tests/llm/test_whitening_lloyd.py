"""Whitening by multiplicities and active-entry Lloyd against direct versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from blockpulse.llm import active_lloyd as al
from blockpulse.llm import multiplicity_whitening as mw
from blockpulse.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def valid(rows):
    return [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]


def random_rows(n, width, seed, copies=0):
    rng = random.Random(seed)
    mix = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(width)]
    rows = []
    for i in range(n):
        f = [rng.gauss(0, 0.2 * (k + 1)) for k in range(width)]
        rows.append((i, [sum(a * b for a, b in zip(f, m)) for m in mix], rng.choice([None, 0, 1, 2])))
    return rows + [(n + k, rows[3][1], 1) for k in range(copies)]


def table_rows(spark, sf):
    return [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]


# --- whitening


def slow_fit(rows, copies_count=True):
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for _, v, _ in rows]
    fit = x if copies_count else sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    return x, n, sums, y.T @ y / n


def check_whitened(rows, got, copies_count=True):
    """`got` maps an id to (n, deviation, whitened, explained)."""
    rows = valid(rows)
    x, n, sums, covariance = slow_fit(rows, copies_count)
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1][:32]
    z, y = [], []
    for (i, _, _), v in zip(rows, x):
        found_n, deviation, whitened, explained = got[i]
        assert found_n == n and deviation == sum((n * c - s) ** 2 for c, s in zip(v, sums))
        assert np.allclose(explained, values / np.trace(covariance), rtol=1e-8, atol=1e-12)
        z.append(whitened)
        y.append([(n * c - s) / n for c, s in zip(v, sums)])
    z, y = np.array(z), np.array(y)
    # The axes behind the whitened vectors are unit eigenvectors, one and the same for all rows.
    axes = np.linalg.lstsq(y, z, rcond=None)[0] * np.sqrt(values)
    assert np.allclose(y @ axes / np.sqrt(values), z, atol=1e-7)
    assert np.allclose(covariance @ axes, axes * values, atol=1e-6 * values[0])
    assert np.allclose(np.linalg.norm(axes, axis=0), 1, atol=1e-7)


def test_whitening_query(spark, sf):
    rows = table_rows(spark, sf)
    got = {}
    found = QUERIES["op12_multiplicity_whitening"](spark, sf).collect()
    assert len(found) == 32 * len(valid(rows)) and all(r.identity_error <= 1e-6 for r in found)
    for r in sorted(found, key=lambda r: r.component):
        entry = got.setdefault(r.vec_id, (r.n, r.deviation, [], []))
        entry[2].append(r.whitened)
        entry[3].append(r.explained)
        assert r.component == len(entry[2])
    check_whitened(rows, got)


@pytest.mark.parametrize("copies_count", [True, False])
def test_whitening_of_copies(spark, copies_count):
    rows = random_rows(120, 5, 2, copies=80)
    found = mw.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), copies_count=copies_count).collect()
    check_whitened(rows, {r.id: (r.n, r.deviation, r.whitened, r.explained) for r in found}, copies_count)
    assert max(r.identity_error for r in found) < 1e-9


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    line = [(i, [float(i), 2.0 * i, 0.5], None) for i in range(6)]
    left_out = [(50, None, 1), (51, [], 1), (52, [1.0, None, 0.0], 1), (53, [nan, 0.0, 0.0], 1), (54, [inf, 0.0, 0.0], 1), (55, [1e300, 0.0, 0.0], 1)]
    others = [(60, [1.0, 2.0], 1), (61, [3.0, 2.5], 1), (None, [0.0, 0.0], 1), (62, [7.0], 1), (63, [1e15, 0.0, 1.0, 1.0], 1), (64, [-1e15, 0.0, 1.0, 1.0], 1)]
    found = mw.whiten(spark.createDataFrame(line + line[2:3] + left_out + others, SCHEMA)).collect()
    by_id = {r.id: r for r in found}
    assert len(found) == 13 and not set(by_id) & {50, 51, 52, 53, 54, 55}
    # Along a line one component varies; the others cannot be whitened.
    assert all(by_id[i].whitened[1:] == [None, None] and by_id[i].explained[0] == pytest.approx(1) and by_id[i].explained[1:] == [0, 0] for i in range(6))
    assert by_id[0].n == 7 and by_id[60].n == 3 and by_id[None].n == 3
    assert by_id[62].whitened == [None] and by_id[62].explained == [None] and by_id[62].deviation == 0
    assert by_id[63].deviation is None and by_id[63].whitened[0] == pytest.approx(-by_id[64].whitened[0])


def test_whitening_empty_table(spark):
    assert mw.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


# --- active-entry Lloyd


def slow_lloyd(rows, parts=8, entries=16, rounds=6):
    rows = sorted(valid(rows), key=lambda r: (r[0] is None, r[0] or 0, [math.floor(4096 * c) for c in r[1]]))
    x = [[math.floor(4096 * float(c)) for c in v] for _, v, _ in rows]
    cuts = al.part_bounds(len(x[0]), parts)
    books = [[v[a:b] for v in x[:entries]] for a, b in cuts]

    def nearest(p, v):
        a, b = cuts[p]
        return min((sum((s - t) ** 2 for s, t in zip(v[a:b], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            groups = {}
            for v in x:
                groups.setdefault(nearest(p, v)[1], []).append(v[a:b])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out, by_label = [], {}
    for (i, _, label), v in zip(rows, x):
        best = [nearest(p, v) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], sha) for i, code, error, label in out), key=str)


def as_rows(df):
    return sorted(((r.id, "".join(f"{c:02x}" for c in r.codes), r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_lloyd_query(spark, sf):
    got = sorted(map(tuple, QUERIES["op13_active_lloyd"](spark, sf).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)
    assert got == slow_lloyd(table_rows(spark, sf))


@pytest.mark.parametrize("width,parts,entries,rounds", [(8, 8, 16, 6), (11, 4, 5, 9), (3, 8, 16, 6), (6, 2, 300, 3), (4, 1, 2, 40)])
def test_lloyd_matches_direct_version(spark, width, parts, entries, rounds):
    rows = random_rows(150, width, width, copies=90) + [(None, [0.25] * width, None), (7, [0.5] * width, 1), (7, [0.5] * width, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert as_rows(al.compress(df, parts, entries, rounds)) == slow_lloyd(rows, parts, entries, rounds)


def test_lloyd_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], None), (3, [-1.0, 0.0], None), (None, [0.0, 0.0], 1)]
    left_out = [(4, None, 1), (5, [], 1), (6, [nan, 0.0], 1), (7, [inf, 0.0], 1), (8, [None, 0.0], 1), (9, [1e9, 0.0], 1)]
    assert as_rows(al.compress(spark.createDataFrame(rows + left_out, SCHEMA))) == slow_lloyd(rows)
    two = al.compress(spark.createDataFrame([*rows, (20, [1.0, 2.0, 3.0], 1)], SCHEMA))
    assert len({r.codebooks_sha256 for r in two.collect()}) == 2
    assert al.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert al.compress(spark.createDataFrame(rows, SCHEMA), label_col=None).select("label_error").distinct().count() == 1


def test_moved_entries_only_are_compared():
    rng = np.random.default_rng(3)
    x = rng.integers(-4, 5, size=(500, 2))  # many ties
    entries = rng.integers(-4, 5, size=(9, 2))
    code, error, compared = al.assign(x, entries, np.ones(9, bool), None, None)
    assert compared == 500 * 9
    for _ in range(20):
        moved = rng.random(9) < 0.3
        entries[moved] = rng.integers(-4, 5, size=(int(moved.sum()), 2))
        whole = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        stays = int((~moved[code]).sum())
        code, error, compared = al.assign(x, entries, moved, code, error)
        assert (code == whole.argmin(axis=1)).all() and (error == whole.min(axis=1)).all()
        assert compared == (500 - stays) * 9 + stays * int(moved.sum())
