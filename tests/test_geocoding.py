"""Nearest places and similar addresses against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from blockpulse.operators import geocoding as geo
from blockpulse.session import scratch_run


def slow_nearest(points, places):
    out = {}
    for i, x, y in points:
        if None not in (x, y) and abs(x) < float("inf") and abs(y) < float("inf"):
            out[i] = min((((px - x) ** 2 + (py - y) ** 2), p) for p, px, py in places if None not in (px, py) and px == px)
    return out


def check_nearest(spark, points, places):
    with scratch_run(spark):
        found = geo.nearest(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(places, "place long, x double, y double")).collect()
    want = slow_nearest(points, places)
    assert len(found) == sum(i in want for i, _, _ in points)
    for r in found:
        assert (r.place, r.distance) == (want[r.id][1], pytest.approx(want[r.id][0] ** 0.5, rel=1e-12, abs=1e-12))


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_with_crowds_and_outliers(spark, seed):
    rng = random.Random(seed)

    def spot():
        kind = rng.random()
        if kind < 0.5:  # a crowd in a tiny corner
            return rng.gauss(5, 1e-5), rng.gauss(5, 1e-5)
        if kind < 0.55:
            return rng.uniform(-900, 900), rng.uniform(-900, 900)
        return rng.uniform(0, 10), float(round(rng.uniform(0, 10)))

    check_nearest(spark, [(i, *spot()) for i in range(400)], [(p, *spot()) for p in range(900)])


def test_nearest_ties_repeats_and_rows_without_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    grid = [(10 * a + b, float(a), float(b)) for a in range(10) for b in range(10)]
    points = [(k, 0.5 * (k % 19), 0.5 * (k // 19)) for k in range(361)] + [(900, None, 1.0), (901, nan, 1.0), (902, inf, 0.0), (903, 3.0, 3.0), (903, 3.0, 3.0)]
    check_nearest(spark, points, grid + [(500, 3.0, 3.0), (501, None, 0.0), (502, nan, 0.0)])
    check_nearest(spark, [(1, 7.0, 7.0), (2, 7.0, 7.0)], [(4, 7.0, 7.0), (3, 7.0, 7.0)])
    check_nearest(spark, [(1, -1e6, 3.0)], [(4, 1e6, 7.0)])


def test_nearest_without_places_or_points(spark):
    points, none = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double"), spark.createDataFrame([], "place long, x double, y double")
    assert geo.nearest(points, none).collect() == []
    assert geo.nearest(points.limit(0), spark.createDataFrame([(1, 0.0, 0.0)], none.schema)).collect() == []


def slow_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def mistyped(rng, text, errors):
    letters = list(text)
    for _ in range(errors):
        at, kind = rng.randrange(len(letters) + 1), rng.randrange(3)
        letters[at : at + (kind > 0)] = [] if kind == 1 else [rng.choice("ABCDE 12")]
    return "".join(letters)


@pytest.mark.parametrize("errors,width", [(1, 2), (2, 3), (3, 2)])
def test_most_similar_matches_brute_force(spark, errors, width):
    rng = random.Random(errors)
    names = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.choice([1, 3, 9, 14]))) for _ in range(40)]
    known = [(p, f"{rng.randrange(300)} {rng.choice(names)} {rng.choice(['ST', 'AVE', ''])}") for p in range(150)]
    asked = [(i, mistyped(rng, rng.choice(known)[1], rng.randrange(errors + 2))) for i in range(150)] + [(900, ""), (901, None), (902, "A"), (903, known[3][1]), (903, known[3][1])]
    known += [(700, "AA"), (701, None), (702, ""), (703, known[3][1])]
    with scratch_run(spark):
        places = spark.createDataFrame(known, "place long, address string")
        found = geo.most_similar(spark.createDataFrame(asked, "id long, address string"), places, "address", "place", errors, width).collect()
    assert len(found) == len(asked)
    for r in found:
        near = [(d, p) for p, k in known if k is not None and r.address is not None and (d := slow_edits(r.address, k)) <= errors]
        assert (r.edits, r.place) == (min(near) if near else (None, None))


def test_few_addresses_are_compared_and_nothing_is_crossed(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(10)) for _ in range(500)]
    known = spark.createDataFrame([(p, f"{rng.randrange(1000)} {n} STREET") for p, n in enumerate(names)], "place long, address string")
    asked = known.select(F.col("place").alias("id"), F.concat(F.substring("address", 1, 6), F.lit("X"), F.expr("substring(address, 8)")).alias("address"))
    with scratch_run(spark):
        found = geo.most_similar(asked, known, "address", "place")
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert all(r.place == r.id for r in rows) and sum(r.candidates for r in rows) < 40 * len(rows)


def test_common_pieces_bring_few_candidates(spark):
    rng = random.Random(7)
    known = [(p, "".join(rng.choice("ABCDEF") for _ in range(24))) for p in range(1500)]  # every piece is in many texts
    with scratch_run(spark):
        places = spark.createDataFrame(known, "place long, address string")
        asked = places.select(F.col("place").alias("id"), F.expr("substring(address, 1, 5) || 'X' || substring(address, 7, 14) || substring(address, 22)").alias("address"))
        rows = geo.most_similar(asked, places, "address", "place").collect()
    assert all((r.place, r.edits) == (r.id, 2) for r in rows) and sum(r.candidates for r in rows) < 20 * len(rows)


@pytest.mark.parametrize("head,tail", [("SOME LONG AVENUE OF THE SAME NAME ", ""), ("", " THE SAME LONG AVENUE"), ("NORTH OF A LONG, LONG ROAD NO ", " IN THE SAME TOWN, COUNTRY AND STATE")])
def test_crowds_meet_again_without_loss(spark, monkeypatch, head, tail):
    monkeypatch.setattr(geo, "SHARING", 1)
    rng = random.Random(11)
    known = [(p, head + "".join(rng.choice("ABCD") for _ in range(7)) + tail) for p in range(80)]
    asked = [(i, mistyped(rng, rng.choice(known)[1], rng.randrange(4))) for i in range(60)]
    with scratch_run(spark):
        places = spark.createDataFrame(known, "place long, address string")
        found = geo.most_similar(spark.createDataFrame(asked, "id long, address string"), places, "address", "place").collect()
    for r in found:
        near = [(d, p) for p, k in known if (d := slow_edits(r.address, k)) <= 2]
        assert (r.edits, r.place) == (min(near) if near else (None, None))


def test_tasks_grow_with_the_spots(spark, monkeypatch):
    monkeypatch.setattr(geo, "SPOTS_PER_TASK", 2)
    spots = spark.range(40).selectExpr("id * 0.7 % 8 AS x", "id * 0.3 % 8 AS y", "3 AS level").selectExpr("CAST(x AS DOUBLE) AS x", "CAST(y AS DOUBLE) AS y", "level")
    places = spots.selectExpr("x + 0.1 AS x", "y", "CAST(x * 10 AS LONG) AS _place")
    met = geo._nine_cells(spots, places, geo._Grid(0.0, 0.0, 8.1), {3: 40}).select("x", "y", "_found.place")
    assert "hashpartitioning(level" in (plan := met._jdf.queryExecution().executedPlan().toString()) and ", 21), REPARTITION_BY_NUM" in plan
    assert met.count() == 40
