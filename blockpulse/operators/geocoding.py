"""Lookups of places that don't match exactly: the nearest by coordinates, the most similar by address.

Neither pairs every row with every place. Coordinates meet the places of their grid cell and of the
eight around it, in a grid that is finer where places crowd; addresses meet the places whose beginning
becomes equal when as many characters are left out as typing errors are wanted, so that none is missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.session import shared_path
from blockpulse.sources.writers import stored

#: Places that a cell holds about; a cell with more than CROWDED times as many is split.
PER_CELL, CROWDED = 2, 4
#: Halvings of the whole area at most; cells beyond that are not split. Halvings between two levels, and more
#: by as much in every further round.
DEEPEST, STEP = 24, 2
#: Spots that a task compares with the places of their nine cells, about.
SPOTS_PER_TASK = 25_000
#: Candidates per address that one way of meeting may bring; characters of an address compared at most before all do.
SHARING, LONGEST = 64, 48


def _kept(df: DataFrame, label: str) -> DataFrame:
    return stored(df, shared_path(df.sparkSession, label))


def _spots(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(x, y, name): distinct finite coordinates with the smallest key there."""
    finite = F.abs("x") < float("inf")  # NULL and NaN are not
    numbers = rows.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), key)
    return numbers.where(finite & (F.abs("y") < float("inf"))).groupBy("x", "y").agg(F.min(key).alias(name))


class _Grid:
    """Square cells over the area of all spots: level 0 is one cell, each level halves their side."""

    def __init__(self, x0: float, y0: float, side: float) -> None:
        self.x0, self.y0, self.side = x0, y0, side or 1.0

    def size(self, level: Column) -> Column:
        return F.lit(self.side) / F.pow(F.lit(2.0), level)

    def at(self, level: Column) -> list[Column]:
        return [F.floor((F.col(c) - F.lit(o)) / self.size(level)).alias(f"c{c}") for c, o in (("x", self.x0), ("y", self.y0))]

    def on(self, spots: DataFrame, levels: list[int]) -> DataFrame:
        """`spots` with level, cx and cy, once for each of the levels."""
        return spots.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]))).select("*", *self.at(F.col("level")))


def nearest(points: DataFrame, places: DataFrame, key: str = "id", place: str = "place") -> DataFrame:
    """(key, place, distance): the nearest place of every point, ties to the smaller place.

    `points` has (key, x, y) and `places` (place, x, y). A point is first compared with the places of its
    cell and the eight around it. If the nearest of them is not further than the border of those nine
    cells, it is certain; other points go on with larger cells, just large enough where a place was
    found. The first cells are so small that they hold a few places each, and where one holds many
    it is split again, so that points start with few places even in a crowded spot. Equal coordinates are
    searched once. Points without finite coordinates are left out, and so are all points if there is no
    place.
    """
    targets = _kept(_spots(places, place, "_place"), "places")
    spots = _kept(_spots(points, key, "_key").drop("_key"), "spots")
    # One row each: the area and the number of places.
    area = targets.select("x", "y", F.lit(1).alias("one")).unionAll(spots.select("x", "y", F.lit(0).alias("one")))
    box = area.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.sum("one").alias("n")).first()
    if not box.n:
        return points.select(key, F.lit(None).cast(places.schema[place].dataType).alias(place), F.lit(0.0).alias("distance")).limit(0)
    grid = _Grid(box.x0, box.y0, max(box.x1 - box.x0, box.y1 - box.y0) * (1 + 1e-9))
    first = 0
    while PER_CELL << (2 * first) < box.n and first < DEEPEST:
        first += 1

    active, done, step = _start_levels(spots, targets, grid, first), [], STEP
    while levels := {r.level: r["count"] for r in active.groupBy("level").count().collect()}:  # at most DEEPEST of them
        found = _kept(_nine_cells(active, targets, grid, levels), "near")
        # The whole area lies in the nine cells of level 0.
        sure = (F.col("level") == 0) | (F.col("_found").isNotNull() & (F.col("_found.d") <= F.col("_margin") * F.col("_margin")))
        done.append(found.where(sure).select("x", "y", F.col("_found.place").alias(place), F.sqrt("_found.d").alias("distance")))
        # The nearest is no further than the place that was found: cells of that side hold it for certain.
        enough = F.floor(F.log2(F.lit(grid.side) / F.sqrt("_found.d")) - 1e-6).cast("int")
        lower = F.greatest(F.lit(0), F.least(F.coalesce(enough, F.col("level") - step), F.col("level") - 1))
        active = found.where(~sure).select("x", "y", lower.alias("level"))
        step += STEP
    answers = _kept(reduce(DataFrame.unionAll, done), "nearest") if done else spots.select("x", "y", F.lit(None).cast(places.schema[place].dataType).alias(place), F.lit(0.0).alias("distance"))
    numbers = points.select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    return numbers.join(answers, ["x", "y"]).select(key, place, "distance")


def _start_levels(spots: DataFrame, targets: DataFrame, grid: _Grid, first: int) -> DataFrame:
    """(x, y, level): each spot starts at `first`, or below the deepest level at which its cell is crowded."""
    levels = list(range(first, DEEPEST, STEP)) or [first]
    cells = grid.on(targets, levels).groupBy("level", "cx", "cy").agg(F.count("*").alias("n"))
    hot = _kept(cells.where(F.col("n") > PER_CELL * CROWDED).drop("n"), "crowded")
    used = [r.level for r in hot.select("level").distinct().collect()]
    if not used:
        return spots.select("x", "y", F.lit(first).alias("level"))
    inside = grid.on(spots, used).join(hot, ["level", "cx", "cy"]).groupBy("x", "y").agg(F.max("level").alias("crowded"))
    return _kept(spots.join(inside, ["x", "y"], "left").select("x", "y", F.coalesce(F.col("crowded") + STEP, F.lit(first)).alias("level")), "starts")


def _nine_cells(spots: DataFrame, targets: DataFrame, grid: _Grid, levels: dict[int, int]) -> DataFrame:
    """(x, y, level, _margin, _found): the nearest place in the nine cells around each spot, and how far their border is.

    `levels` counts the spots of each level. What meets is sorted by spot, so the tasks grow in number with the spots, not in size.
    """
    size = grid.size(F.col("level"))
    own = spots.select("x", "y", "level", *grid.at(F.col("level")))
    # A little less than the distance to the border, for the rounding of the cell.
    low = [F.col(c) - (F.lit(o) + (F.col(f"c{c}") - 1) * size) for c, o in (("x", grid.x0), ("y", grid.y0))]
    margin = F.least(*low, *[3 * size - d for d in low]) - 1e-9 * size
    around = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    asked = own.select("x", "y", "level", F.inline(around))
    held = grid.on(targets, list(levels)).select("level", "cx", "cy", F.col("x").alias("px"), F.col("y").alias("py"), "_place")
    tasks = max(spots.sparkSession.sparkContext.defaultParallelism, sum(levels.values()) // SPOTS_PER_TASK + 1)
    asked, held = (side.repartition(tasks, "level", "cx", "cy") for side in (asked, held))
    d = (F.col("px") - F.col("x")) * (F.col("px") - F.col("x")) + (F.col("py") - F.col("y")) * (F.col("py") - F.col("y"))
    met = asked.join(held, ["level", "cx", "cy"]).groupBy("x", "y").agg(F.min(F.struct(d.alias("d"), F.col("_place").alias("place"))).alias("_found"))
    return own.select("x", "y", "level", margin.alias("_margin")).join(met, ["x", "y"], "left")


# --- similar addresses -----------------------------------------------------------------------


def _deletions(text: Column, most: int) -> Column:
    """The text without up to `most` of its characters, in every way."""
    step = F.array(F.struct(text.alias("t"), F.lit(1).alias("i")))  # the next character goes at i or later
    out = step
    for _ in range(most):
        step = F.flatten(F.transform(step, lambda v: F.transform(
            F.when(v["i"] <= F.length(v["t"]), F.sequence(v["i"], F.length(v["t"]))).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(F.concat(F.substring(v["t"], F.lit(1), i - 1), F.substring(v["t"], i + 1, F.length(v["t"]))).alias("t"), i.alias("i")),
        )))
        out = F.concat(out, step)
    return F.array_distinct(F.transform(out, lambda v: v["t"]))


def _meeting(texts: DataFrame, size: int, backwards: bool, errors: int) -> DataFrame:
    """(key, id, side, asked, known): the keys of each text that both sides have, and how many texts of each have them.

    A text's keys are its first (or last) `size` characters without `errors` of them, or without up to
    `errors` if it is shorter.
    """
    end = F.substring(F.reverse("text") if backwards else F.col("text"), 1, size)
    rests = _deletions(end, errors)
    rests = F.when(F.length("text") >= size, F.filter(rests, lambda t: F.length(t) == size - errors)).otherwise(rests)
    spread = texts.select("id", "side", F.explode(rests).alias("rest")).select(F.xxhash64("rest").alias("key"), "id", "side")
    here = Window.partitionBy("key")
    counted = spread.withColumns({"asked": F.sum(1 - F.col("side")).over(here), "known": F.sum("side").over(here)})
    return counted.where((F.col("asked") > 0) & (F.col("known") > 0))


def similar_pairs(asked: DataFrame, known: DataFrame, errors: int = 2, width: int = 3) -> DataFrame:
    """(text, other): candidates that contain every pair of an asked and a known text within `errors` edits.

    Both frames hold distinct texts in the column `text`. Two texts within `errors` edits become equal when
    at most `errors` characters are left out of each, and so do their beginnings of one length, and their
    ends: texts meet where their first 2 * errors * width characters do so. Texts that meet in a crowd meet
    again by their ends, then by longer beginnings and ends, until a crowd is left by LONGEST characters only.
    """
    numbered = asked.select("text", F.lit(0).alias("side")).unionAll(known.select("text", F.lit(1).alias("side")))
    texts = _kept(numbered.withColumn("id", F.monotonically_increasing_id()), "texts")
    whole = texts.agg(F.max(F.length("text"))).first()[0] or 0
    active, size, backwards, pairs = texts, 2 * errors * width, False, []
    crowd = F.col("asked") * F.col("known") > SHARING * (F.col("asked") + F.col("known"))
    while True:
        met = _kept(_meeting(active, size, backwards, errors), "meeting")
        last = size >= min(whole, max(LONGEST, 2 * errors * width)) and (backwards or size >= whole)
        few = met if last else met.where(~crowd)
        left, right = (few.where(F.col("side") == i).select("key", F.col("id").alias(n)) for i, n in enumerate(("_asked", "_known")))
        pairs.append(left.join(right, "key").select("_asked", "_known"))
        again = None if last else _kept(met.where(crowd).select("id").distinct(), "crowd")
        if again is None or again.isEmpty():
            break
        active = texts.join(again, "id", "left_semi")
        size, backwards = (min(size * 3 // 2, max(LONGEST, size)), False) if backwards else (size, True)
    left, right = (texts.where(F.col("side") == i).select(F.col("id").alias(n), F.col("text").alias(t)) for i, n, t in ((0, "_asked", "text"), (1, "_known", "other")))
    found = reduce(DataFrame.unionAll, pairs).distinct().join(left, "_asked").join(right, "_known")
    return found.where(F.abs(F.length("text") - F.length("other")) <= errors).select("text", "other")


def most_similar(rows: DataFrame, places: DataFrame, text: str, place: str, errors: int = 2, width: int = 3) -> DataFrame:
    """`rows` with the place whose address is fewest edits away, at most `errors`: place, known_text, edits, candidates.

    Ties go to the smaller place. Rows without such a place, and rows without an address, have NULLs.
    `candidates` counts the known addresses that were compared.
    """
    known = _kept(places.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(place).alias(place)), "known")
    asked = _kept(rows.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct(), "asked")
    pairs = similar_pairs(asked, known.select("text"), errors, width)
    edits = F.levenshtein("text", "other", errors)
    compared = pairs.withColumn("edits", edits).join(known.select(F.col("text").alias("other"), place), "other")
    best = F.min(F.when(F.col("edits") >= 0, F.struct("edits", F.col(place).alias("place"), F.col("other").alias("known_text")))).alias("best")
    found = _kept(compared.groupBy("text").agg(best, F.count("*").alias("candidates")), "similar")
    answers = found.select(F.col("text").alias("_text"), F.col("best.place").alias(place), "best.known_text", "best.edits", "candidates")
    joined = rows.join(answers, F.col(text) == F.col("_text"), "left").drop("_text")
    return joined.withColumn("candidates", F.coalesce("candidates", F.lit(0)).cast("long"))
