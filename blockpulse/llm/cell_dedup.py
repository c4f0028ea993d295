"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one vector kept per group.

Equal vectors are one class and compared once. Each class lives in the cell of its nearest centroid
and also looks into the cells of lower number where a partner can live. If x and y have cosine s, y is
s * x plus sqrt(1 - s * s) times a unit vector z across x, so y prefers another cell's centroid c to
that of x's own cell h only if sqrt(1 - s * s) * z * (c - h) makes up for s * x * (h - c). As z lies
across x, that needs x * (h - c) <= |c - h| * sqrt(1 - s * s). Nor can y be in c if the angle of x to c
is further from the angles of c's own vectors than the angle between partners. Both bounds hold for any
vectors, so no partner is missed. Where vectors do not cluster they leave out few cells, and about every
pair is compared.

Vectors are sent to regions: neighbouring cells of about `side` vectors together, numbered on end. A
vector that looks into any cell of a region of lower number is that region's guest, once. Within a
region, residents and guests come in sides of bounded size, a task per pair of sides, which multiplies
them block by block; it returns the number of links of each class and a spanning forest of the links,
so no group is ever spelled out as pairs.

There are MOST_CELLS cells at most. In a table so large that cells hold more than SPLIT vectors, such a cell
gets centroids, cells and regions of its own, for its residents and its guests, under the same bounds.

Rows and edge cases: vectors that are NULL, zero, or hold NULL or non-finite components link with
nothing, nor do rows without an id: each is a group of its own and kept. Vectors of each length are
compared among themselves. Repeated rows are vectors of their own that link to each other. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.llm.components import smallest_ids
from blockpulse.llm.scratch import Scratch
from blockpulse.llm.vector_blocks import bounded_sample, lengths, matrix, takes_part

COSINE = 0.9
#: Classes that centroids are fitted on, and cells, at most; passes of k-means; rows of a block.
SAMPLE, MOST_CELLS, PASSES, BLOCK = 16_384, 2048, 8, 1024
#: Blocks and components of a side, at most, and sides that all classes make, at least, if they fill a block each.
SIDE, SIDE_VALUES, LEAST_SIDES = 8, 8 << 20, 16
#: Residents of a cell beyond which it is cut into cells of its own.
SPLIT = 32_768


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that squares neither overflow nor vanish."""
    if not len(vectors):
        return vectors
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, cells: int, seed: int = 5) -> np.ndarray:
    """Unit centroids; a cell that loses all its vectors keeps its centroid."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.permutation(len(vectors))[:cells]].copy()
    for _ in range(PASSES):
        home = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(vectors, max(1, len(vectors) // 2048))])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        length = np.sqrt((sums * sums).sum(axis=1))
        centres[length > 0] = sums[length > 0] / length[length > 0, None]
    return centres


def regions(centres: np.ndarray, sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """The cells of each region: halved along their widest direction until they hold `most` vectors or are one cell."""
    done, left = [], [np.arange(len(sizes))]
    while left:
        cells = left.pop()
        if len(cells) == 1 or sizes[cells].sum() <= most:
            done.append(cells)
            continue
        around = centres[cells] - centres[cells].mean(axis=0)
        cells = cells[np.argsort(around @ np.linalg.svd(around, full_matrices=False)[2][0], kind="stable")]
        upto = np.cumsum(sizes[cells])
        cut = int(np.abs(upto[:-1] - upto[-1] / 2).argmin()) + 1
        left += [cells[cut:], cells[:cut]]
    return done


def visits(vectors: np.ndarray, home: np.ndarray, centres: np.ndarray, angles: np.ndarray, cosine: float) -> np.ndarray:
    """True where a partner of a vector of cell `home` can live in a cell. angles: least and greatest of each cell's own vectors to its centroid.

    The margins are above the rounding of a root and an arc cosine near 0.
    """
    near = vectors @ centres.T
    behind = near[np.arange(len(vectors)), home][:, None] - near
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres[home] @ centres.T))
    across = (1 - cosine * cosine) ** 0.5 if cosine > 0 else 1.0
    angle, most = np.arccos(np.clip(near, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    ringed = (angle <= angles[1] + most + 1e-6) & (angle >= angles[0] - most - 1e-6)
    return ringed & (behind <= apart * across + 1e-7)


def _fit_centres(sample: DataFrame, cells: int) -> np.ndarray:
    """Centroids of the sample, fitted in one task."""

    def fitted(table: pa.Table) -> pa.Table:
        centres = spherical_kmeans(unit(matrix(table.sort_by("node").column("vector"))), cells)
        return pa.table({"centres": pa.array([centres.tobytes()], pa.binary()), "width": [centres.shape[1]]})

    one = sample.select("node", "vector", F.lit(0).alias("all")).groupBy("all").applyInArrow(fitted, "centres binary, width long").first()
    return np.frombuffer(one.centres, np.float64).reshape(-1, one.width)


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the nodes as the pairs of `left` and `right` do: each node to one of its group."""
    nodes, number = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = number[: len(left)], number[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        step = root.copy()
        np.minimum.at(step, a, low)
        np.minimum.at(step, b, low)
        step = step[step]
        if (step == root).all():
            break
        root = step
    apart = root != np.arange(len(nodes))
    return nodes[apart], nodes[root[apart]]


def _compare(cosine: float) -> Callable[[pa.Table], pa.Table]:
    def compare(table: pa.Table) -> pa.Table:
        itself = (table.column("side").to_numpy() == 1).any()
        table = table.sort_by("node") if itself else table
        left, right = table.filter(table.column("side").to_numpy() < 2), table.filter(table.column("side").to_numpy() > 0)
        sides = [(unit(matrix(x.column("vector"))), x.column("node").to_numpy(), x.column("n").to_numpy()) for x in (left, right)]
        (a, left_node, left_n), (b, right_node, right_n) = sides
        left_own, right_own = (x.column("own").to_numpy(zero_copy_only=False) for x in (left, right))
        left_links, right_links, ends, roots = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), [], []
        for i in range(0, len(a), BLOCK):
            for j in range(i if itself else 0, len(b), BLOCK):
                rows, cols = slice(i, i + BLOCK), slice(j, j + BLOCK)
                close = a[rows] @ b[cols].T >= cosine
                close &= left_own[rows, None] | right_own[None, cols]
                if itself:  # each pair once
                    close &= left_node[rows, None] < right_node[None, cols]
                left_links[rows] += close @ right_n[cols]
                right_links[cols] += left_n[rows] @ close
                at, to = np.nonzero(close)
                for found, edges in zip((ends, roots), _forest(left_node[rows][at], right_node[cols][to])):
                    found.append(edges)
        end, root = _forest(np.concatenate(ends), np.concatenate(roots)) if ends else (left_node[:0], left_node[:0])
        node = np.concatenate([left_node[left_links > 0], right_node[right_links > 0], end])
        links = np.concatenate([left_links[left_links > 0], right_links[right_links > 0], np.zeros(len(end), np.int64)])
        other = [None] * (len(node) - len(end)) + root.tolist()
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64()), "other": pa.array(other, pa.int64())})

    return compare


def _tasks() -> Column:
    """The pairs of sides that a row takes part in, as (first, second, with_guests, side).

    Residents of side b meet residents of every side, once, and every side of guests; guests meet
    every side of residents. side: 0 first side, 2 second side, 1 both.
    """

    def pair(first: Column, second: Column, guests: bool, side: Column) -> Column:
        return F.struct(first.cast("int").alias("first"), second.cast("int").alias("second"), F.lit(guests).alias("guests"), side.alias("side"))

    def upto(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    own = F.col("part")
    residents = F.transform(
        upto("resident_sides"), lambda j: pair(F.least(own, j), F.greatest(own, j), False, F.when(own == j, 1).when(own < j, 0).otherwise(2))
    )
    to_guests = F.transform(upto("guest_sides"), lambda j: pair(own, j, True, F.lit(0)))
    to_residents = F.transform(upto("resident_sides"), lambda i: pair(i, own, True, F.lit(2)))
    return F.when(F.col("resident"), F.concat(residents, to_guests)).otherwise(to_residents)


def _split(stays: DataFrame, crowded: DataFrame, side: int, cosine: float, sample: int, scratch: Scratch) -> DataFrame:
    """`stays` with the crowded regions (region, residents) cut into regions of their own cells.

    Centroids are fitted on a bounded sample of each crowded region's residents, one task per region. The bounds
    of `visits` hold for any centroids, so members, residents and guests alike, get a cell among them and
    look into the cells where a partner can live. `own` keeps who was a resident before: two guests meet
    where one of them lives and are not compared here.
    """
    inside = scratch.write(stays.join(crowded, "region").select(*stays.columns, "residents"), "crowded-rows", merged=False)
    chosen = inside.where(F.col("resident") & (F.shiftrightunsigned(F.xxhash64("node"), 34) <= F.least(F.lit(1.0), sample / F.col("residents")) * (1 << 30)))
    kind = stays.schema["vector"].dataType.simpleString()

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").slice(0, sample)
        cells = max(1, min(MOST_CELLS, round(table.column("residents")[0].as_py() ** 0.5)))
        centres = spherical_kmeans(unit(matrix(table.column("vector"))), cells)
        return pa.table({"region": table.column("region").slice(0, 1), "centres": pa.array([centres.tobytes()], pa.binary()), "width": [centres.shape[1]]})

    fits = scratch.write(chosen.select("region", "node", "vector", "residents").groupBy("region").applyInArrow(fitted, "region long, centres binary, width long"), "sub-centres", merged=False)
    members = scratch.write(inside.groupBy("region").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("long").alias("blocks")), "members")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")

    def dealt(rows: DataFrame, models: DataFrame, step: Callable, schema: str) -> DataFrame:
        """Apply a step to blocks of a region's rows, each with the region's model."""
        left = rows.join(members, "region").select(*rows.columns, F.pmod(F.xxhash64("node"), "blocks").alias("block"))
        right = models.join(members, "region").select(*models.columns, each)
        return left.groupBy("region", "block").cogroup(right.groupBy("region", "block")).applyInArrow(step, schema)

    def housed(rows: pa.Table, model: pa.Table) -> pa.Table:
        centres = np.frombuffer(model.column("centres")[0].as_py(), np.float64).reshape(-1, model.column("width")[0].as_py())
        near = unit(matrix(rows.column("vector"))) @ centres.T if rows.num_rows else np.zeros((0, len(centres)))
        rows = rows.drop_columns(["block"])
        return rows.append_column("home", pa.array(near.argmax(axis=1), pa.int32())).append_column("angle", pa.array(np.arccos(np.clip(near.max(axis=1, initial=-1), -1, 1)), pa.float64()))

    narrow = inside.select("node", "n", "vector", "region", F.col("resident").alias("own"))
    homes = scratch.write(dealt(narrow, fits, housed, f"node long, n long, vector {kind}, region long, own boolean, home int, angle double"), "sub-homes", merged=False)
    cells = homes.groupBy("region", "home").agg(F.count("*").alias("n"), F.min("angle").alias("least"), F.max("angle").alias("most"))

    def planned(cells: pa.Table, model: pa.Table) -> pa.Table:
        centres = np.frombuffer(model.column("centres")[0].as_py(), np.float64).reshape(-1, model.column("width")[0].as_py())
        count, angles = np.zeros(len(centres), np.int64), np.tile([[np.inf], [-np.inf]], len(centres))
        at = cells.column("home").to_numpy()
        count[at], angles[0, at], angles[1, at] = (cells.column(c).to_numpy() for c in ("n", "least", "most"))
        groups = regions(centres, count, side)
        numbers = {"angles": angles, "order": np.concatenate(groups).astype(np.int64), "starts": np.cumsum([0, *map(len, groups[:-1])]).astype(np.int64)}
        return model.select(["region", "centres", "width"]).append_column("angles", pa.array([angles.tobytes()], pa.binary())).append_column(
            "order", pa.array([numbers["order"].tolist()], pa.list_(pa.int64()))).append_column("starts", pa.array([numbers["starts"].tolist()], pa.list_(pa.int64())))

    plans = cells.groupBy("region").cogroup(fits.groupBy("region")).applyInArrow(planned, "region long, centres binary, width long, angles binary, order array<long>, starts array<long>")
    plans = scratch.write(plans, "sub-plans", merged=False)

    def placed(rows: pa.Table, model: pa.Table) -> pa.Table:
        plan = model.to_pylist()[0]
        centres, angles = np.frombuffer(plan["centres"], np.float64).reshape(-1, plan["width"]), np.frombuffer(plan["angles"], np.float64).reshape(2, -1)
        order, starts = np.array(plan["order"]), np.array(plan["starts"])
        sub = np.empty(len(order), np.int64)
        sub[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(order)]))
        home, chosen = rows.column("home").to_numpy(), []
        for i in range(0, len(home), 2048):
            part = slice(i, i + 2048)
            looks = visits(unit(matrix(rows.column("vector").slice(i, 2048))), home[part], centres, angles, cosine)
            guest = np.logical_or.reduceat(looks[:, order], starts, axis=1) & (np.arange(len(starts)) < sub[home[part]][:, None])
            chosen += [np.flatnonzero(r).tolist() for r in guest]
        kept = rows.select(["node", "n", "vector", "region", "own"])
        return kept.append_column("sub", pa.array(sub[home], pa.int64())).append_column("guest_in", pa.array(chosen, pa.list_(pa.int64())))

    cut = scratch.write(dealt(homes, plans, placed, f"node long, n long, vector {kind}, region long, own boolean, sub long, guest_in array<long>"), "sub-placed", merged=False)
    number = F.col("region") * (1 << 24) + (1 << 40)  # apart from the numbers of the other regions
    places = F.concat(F.array(F.struct((number + F.col("sub")).alias("region"), F.lit(True).alias("resident"))),
                      F.transform("guest_in", lambda c: F.struct((number + c).alias("region"), F.lit(False).alias("resident"))))
    parted = cut.select("node", "n", "vector", F.inline(places), "own").select(*stays.columns)
    return stays.join(crowded.select("region"), "region", "left_anti").select(*stays.columns).unionAll(parted)


def _links(classes: DataFrame, total: int, cosine: float, cells: int | None, sample: int, scratch: Scratch) -> DataFrame:
    """(node, links, other): the links of classes of one length, and edges that connect their groups."""
    spark = classes.sparkSession
    cells = cells or max(1, min(MOST_CELLS, round(total**0.5)))
    centres = spark.sparkContext.broadcast(_fit_centres(bounded_sample(classes, sample, total, F.col("node")), cells))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (batch.slice(i, 2048) for batch in batches for i in range(0, batch.num_rows, 2048))

    def housed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            near = unit(matrix(part.column(2))) @ centres.value.T
            added = [pa.array(near.argmax(axis=1).astype(np.int32)), pa.array(np.arccos(np.clip(near.max(axis=1), -1, 1)) if len(near) else [], pa.float64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=["node", "n", "vector", "home", "angle"])

    kind = classes.schema["vector"].dataType.simpleString()
    homes = classes.select("node", "n", "vector").mapInArrow(housed, f"node long, n long, vector {kind}, home int, angle double")
    homes = scratch.write(homes, "homes")
    # One row per cell, at most MOST_CELLS.
    count, angles = np.zeros(len(centres.value), np.int64), np.tile([[np.inf], [-np.inf]], len(centres.value))
    for r in homes.groupBy("home").agg(F.count("*").alias("n"), F.min("angle").alias("least"), F.max("angle").alias("most")).collect():
        count[r.home], angles[:, r.home] = r.n, (r.least, r.most)
    side = BLOCK * max(1, min(SIDE, total // (LEAST_SIDES * BLOCK), SIDE_VALUES // (BLOCK * centres.value.shape[1])))
    cells_of = regions(centres.value, count, side)
    order, starts = np.concatenate(cells_of), np.cumsum([0, *map(len, cells_of[:-1])])
    region = np.empty(len(order), np.int32)
    region[order] = np.repeat(np.arange(len(cells_of)), [len(x) for x in cells_of])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            home = part.column(3).to_numpy()
            looks = visits(unit(matrix(part.column(2))), home, centres.value, angles, cosine) if len(home) else np.zeros((0, len(order)), bool)
            guest = np.logical_or.reduceat(looks[:, order], starts, axis=1) & (np.arange(len(starts)) < region[home][:, None])
            chosen = pa.array([np.flatnonzero(r).tolist() for r in guest], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(region[home]), chosen], names=["node", "n", "vector", "region", "guest_in"])

    placed_rows = homes.mapInArrow(placed, f"node long, n long, vector {kind}, region int, guest_in array<int>")
    placed_rows = scratch.write(placed_rows, "placed")
    scratch.drop(homes)
    places = F.concat(F.array(F.struct(F.col("region"), F.lit(True).alias("resident"))),
                      F.transform("guest_in", lambda c: F.struct(c.alias("region"), F.lit(False).alias("resident"))))
    stays = placed_rows.select("node", "n", "vector", F.inline(places)).withColumns({"region": F.col("region").cast("long"), "own": F.lit(True)})
    # Cells grow with the table once there are MOST_CELLS of them; those that got large are cut again.
    crowded = scratch.write(placed_rows.groupBy(F.col("region").cast("long").alias("region")).agg(F.count("*").alias("residents")).where(F.col("residents") > SPLIT), "crowded")
    if not crowded.isEmpty():
        stays = scratch.write(_split(stays, crowded, side, cosine, sample, scratch), "stays", merged=False)
    sides = {name: F.ceil(F.sum(F.when(cond, 1).otherwise(0)) / side).cast("int").alias(name) for name, cond in (("resident_sides", F.col("resident")), ("guest_sides", ~F.col("resident")))}
    sizes = scratch.write(stays.groupBy("region").agg(*sides.values()), "regions")
    spread = F.xxhash64("node")
    part = F.pmod(spread, F.greatest(F.lit(1), F.when(F.col("resident"), F.col("resident_sides")).otherwise(F.col("guest_sides")))).cast("int")
    tasks = stays.join(sizes, "region").withColumn("part", part).select("node", "n", "vector", "region", F.col("own"), F.inline(_tasks()))
    found = tasks.groupBy("region", "first", "second", "guests").applyInArrow(_compare(cosine), "node long, links long, other long")
    found = scratch.write(found, "found")
    scratch.drop(placed_rows, sizes)
    return found


def near_duplicates(
    table: DataFrame, cosine: float = COSINE, cells: int | None = None, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row. `cells` is by default the root of the classes."""
    spark = table.sparkSession
    scratch = Scratch(spark, "cells")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    valid = rows.where(F.col("id").isNotNull() & takes_part(F.col("vector")))
    classes = valid.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = scratch.write(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sizes = lengths(classes, "vector")
    if not sizes:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    tables = []
    for length, total in sizes.items():
        if total > 1:
            tables.append(_links(classes.where(F.size("vector") == length), total, cosine, cells, sample, scratch))
    found = reduce(DataFrame.unionAll, tables, spark.createDataFrame([], "node long, links long, other long"))

    links = found.where("other IS NOT NULL").select(F.greatest("node", "other").alias("b"), F.least("node", "other").alias("a")).distinct()
    links = scratch.write(links.select("a", "b"), "links")
    groups = smallest_ids(classes.select("node", "id"), links, scratch)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(groups.select("node", "component_id"), "node").join(counts, "node", "left")
    known = scratch.write(known.select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "known")
    scratch.drop(*tables, links, groups)

    asked = rows.select("id", F.when(F.col("id").isNotNull(), F.col("vector")).alias("vector"))
    out = asked.join(known, "vector", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
