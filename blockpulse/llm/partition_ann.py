"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into balanced parts, and a small classifier
learns which part a vector's neighbours are in. It assigns every row to a partition, and routes every
query to its most probable partitions, whose rows are reranked by exact distance. How much probability
a query follows is set on queries from the sample, so that the wanted recall is met there.

A table of more than PARTS * LEAF rows gets partitions of partitions: within each partition a graph and a
classifier of its own are learned on a bounded sample of its rows, one task per partition, and so on until
partitions hold about LEAF rows. Rows and queries go down level by level, so the work of a query depends on
how many partitions it follows and not on the size of the table. The wanted recall is shared among the levels.

Partitions are split into blocks of bounded size, and the queries that reach a block into groups, so a
task holds one block and one group, whatever the size of a partition.

Rows and edge cases: vectors that are NULL, zero, or hold NULL or non-finite components take no part,
nor do rows without an id; vectors of each length are searched among themselves; an id that rows repeat
is one candidate, at its nearest distance, and one query, with its smallest vector; rows with the query's own
id are no candidates; ties go to the smaller id; fewer candidates than `k` give fewer rows; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch
from blockpulse.llm.vector_blocks import bounded_sample, lengths, matrix, takes_part

#: Vectors that the partitions are learned on, at most; partitions; recall wanted on the sample.
SAMPLE, PARTS, RECALL = 8192, 16, 0.95
#: Neighbours in the graph, hidden units and passes of the classifier.
GRAPH, HIDDEN, PASSES = 16, 128, 15
#: Rows of a block and queries of a group.
BLOCK, GROUP = 4096, 1024
#: Rows of a partition, about, where there is more than one level of them.
LEAF = 4096


def nearest(vectors: np.ndarray, k: int, queries: np.ndarray) -> np.ndarray:
    """Row numbers of the k nearest vectors of each queried row, itself left out."""
    sizes, out = (vectors * vectors).sum(1), []
    for rows in np.array_split(queries, max(1, len(queries) // 512)):
        distance = sizes[None, :] - 2 * vectors[rows] @ vectors.T
        distance[np.arange(len(rows)), rows] = np.inf
        out.append(np.argpartition(distance, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def halve(size: int, left: np.ndarray, right: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    """True for the nodes of one of two sides with few edges between them; that side has the given share.

    Nodes are ordered by a slowly mixing direction of the random walk on the graph and cut there; then
    equal numbers of nodes change sides as long as that saves edges.
    """
    degree = np.bincount(left, minlength=size) + 1e-9
    order = rng.normal(size=size)
    for _ in range(60):
        order -= (order * degree).sum() / degree.sum()
        order = 0.5 * order + 0.5 * np.bincount(right, weights=order[left], minlength=size) / degree
        order /= np.abs(order).max() + 1e-30
    side = np.zeros(size, dtype=bool)
    side[np.argsort(order, kind="stable")[: round(size * share)]] = True
    for _ in range(30):
        gain = degree - 2 * np.bincount(left, weights=side[left] == side[right], minlength=size)
        here, there = np.flatnonzero(side), np.flatnonzero(~side)
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        pairs = min(len(here), len(there))
        swapped = int((gain[here[:pairs]] + gain[there[:pairs]] > 2).sum()) // 2
        if not swapped:
            break
        side[here[:swapped]], side[there[:swapped]] = False, True
    return side


def balanced_parts(neighbours: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A part for each node of the neighbour graph, by halving it again and again."""
    size, width = neighbours.shape
    one, two = np.repeat(np.arange(size), width), neighbours.ravel()
    left, right = np.concatenate([one, two]), np.concatenate([two, one])
    part, work = np.zeros(size, dtype=np.int64), [(np.arange(size), 0, parts)]
    while work:
        nodes, first, count = work.pop()
        if count == 1 or len(nodes) < 2:
            part[nodes] = first
            continue
        place = np.full(size, -1)
        place[nodes] = np.arange(len(nodes))
        inside = (place[left] >= 0) & (place[right] >= 0)
        half = count // 2
        side = halve(len(nodes), place[left[inside]], place[right[inside]], half / count, rng)
        work += [(nodes[side], first, half), (nodes[~side], first + half, count - half)]
    return part


@dataclass
class Router:
    """A classifier with one hidden layer, and the probability that a query follows."""

    layers: list[np.ndarray]
    scale: float
    mass: float = 1.0

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum(vectors * self.scale @ self.layers[0] + self.layers[1], 0)
        logits = hidden @ self.layers[2] + self.layers[3]
        weights = np.exp(logits - logits.max(axis=1, keepdims=True))
        return weights / weights.sum(axis=1, keepdims=True)

    def routes(self, vectors: np.ndarray) -> np.ndarray:
        """True where a query goes to a partition: its most probable ones until the mass is reached."""
        p = self.probabilities(vectors)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
        chosen = np.zeros(p.shape, dtype=bool)
        np.put_along_axis(chosen, order, before < self.mass, 1)
        return chosen


def train_classifier(x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, rate: float = 2e-3) -> list[np.ndarray]:
    """Layers fitted to the wanted shares of parts by cross-entropy, with adaptive moments."""
    width, parts = x.shape[1], wanted.shape[1]
    layers = [rng.normal(size=(width, HIDDEN)) * (2 / width) ** 0.5, np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) * HIDDEN**-0.5, np.zeros(parts)]
    mean, square, step = [0 * a for a in layers], [0 * a for a in layers], 0
    for _ in range(PASSES):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            step += 1
            before = x[rows] @ layers[0] + layers[1]
            hidden = np.maximum(before, 0)
            logits = hidden @ layers[2] + layers[3]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = (error @ layers[2].T) * (before > 0)
            slopes = [x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * layers[i]
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope**2
                layers[i] = layers[i] - rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return layers


def learn(vectors: np.ndarray, parts: int, k: int, recall: float, seed: int = 3) -> Router:
    """Partitions and router of a sample."""
    rng, width = np.random.default_rng(seed), vectors.shape[1]
    scale = float(width**0.5 / max(1e-30, np.sqrt((vectors * vectors).sum(1)).mean()))
    if len(vectors) < 4 * parts or parts < 2:
        return Router([np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], scale)
    neighbours = nearest(vectors, min(GRAPH, len(vectors) - 1), np.arange(len(vectors)))
    part = balanced_parts(neighbours, parts, rng)
    own = np.eye(parts)[part]
    router = Router(train_classifier(vectors * scale, 0.5 * own + 0.5 * own[neighbours].mean(axis=1), rng), scale)
    # The share of neighbours found if queries follow a given mass, over the sample's own rows.
    home = router.probabilities(vectors).argmax(axis=1)
    queries = rng.permutation(len(vectors))[:1024]
    found = nearest(vectors, min(k, len(vectors) - 1), queries)
    for mass in np.arange(0.30, 1.0, 0.01):
        router.mass = float(mass)
        if np.take_along_axis(router.routes(vectors[queries]), home[found], 1).mean() >= recall:
            return router
    router.mass = 1.0
    return router


_ROUTER = "layers array<binary>, shapes array<array<bigint>>, scale double, mass double"


def _learned(parts: int, k: int, recall: float, sample: int) -> Callable[[pa.Table], pa.Table]:
    """The router of a group of (part, id, vector) as one row."""

    def learned(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        router = learn(matrix(table.sort_by("id").slice(0, sample).column("vector")), parts, k, recall)
        shapes = [list(a.shape) for a in router.layers]
        return pa.table({
            "part": pa.array([part], pa.int64()), "layers": pa.array([[np.ascontiguousarray(a, np.float64).tobytes() for a in router.layers]], pa.list_(pa.binary())),
            "shapes": pa.array([shapes], pa.list_(pa.list_(pa.int64()))), "scale": [router.scale], "mass": [router.mass],
        })

    return learned


def _router(row: dict) -> Router:
    return Router([np.frombuffer(b, np.float64).reshape(s) for b, s in zip(row["layers"], row["shapes"])], row["scale"], row["mass"])


def _train(sample: DataFrame, parts: int, k: int, recall: float) -> Router:
    """Learn on the sample in one task; only the layers come back."""
    one = sample.select(F.lit(0).cast("long").alias("part"), "id", "vector").groupBy("part").applyInArrow(_learned(parts, k, recall, SAMPLE), f"part long, {_ROUTER}")
    return _router(one.first().asDict())


def fans(total: int, parts: int) -> list[int]:
    """Partitions at each level: one level of `parts` while that leaves LEAF rows or less to each, else equal levels."""
    levels = 1
    while parts > 1 and parts**levels * LEAF < total:
        levels += 1
    return [parts] if levels == 1 else [max(2, math.ceil((total / LEAF) ** (1 / levels)))] * levels


def _routers_within(index: DataFrame, fan: int, k: int, recall: float, sample: int) -> DataFrame:
    """(part, router columns, blocks): a router for each partition, learned on a bounded sample of its rows."""
    counts = index.groupBy("part").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), sample / F.col("n"))
    chosen = index.join(counts, "part").where(F.shiftrightunsigned(F.xxhash64("id"), 34) <= share * (1 << 30))
    routers = chosen.select("part", "id", "vector").groupBy("part").applyInArrow(_learned(fan, k, recall, sample), f"part long, {_ROUTER}")
    return routers.join(counts.select("part", F.ceil(F.col("n") / (8 * BLOCK)).cast("long").alias("blocks")), "part")


def _descended(rows: DataFrame, routers: DataFrame, fan: int, everywhere: bool) -> DataFrame:
    """`rows` (id, vector, part) one level down: in their most probable part, or (`everywhere`) in all that a query follows.

    A partition's rows are dealt over blocks of bounded size, and its router goes to each of them.
    """

    def down(group: pa.Table, router: pa.Table) -> pa.Table:
        out = {"id": pa.array([], pa.int64()), "vector": pa.array([], kind), "part": pa.array([], pa.int64())}
        if group.num_rows and router.num_rows:
            of, vectors, part = _router(router.slice(0, 1).to_pylist()[0]), matrix(group.column("vector")), group.column("part")[0].as_py()
            if everywhere:
                row, child = np.nonzero(of.routes(vectors))
            else:
                row, child = np.arange(len(vectors)), of.probabilities(vectors).argmax(axis=1)
            taken = group.take(pa.array(row))
            out = {"id": taken.column("id"), "vector": taken.column("vector"), "part": pa.array(part * fan + child, pa.int64())}
        return pa.table(out)

    simple = rows.schema["vector"].dataType
    kind = pa.list_(pa.float32() if simple.elementType.typeName() == "float" else pa.float64())
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    dealt = rows.join(routers.select("part", "blocks"), "part").select("id", "vector", "part", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
    cell = ["part", "block"]
    return dealt.groupBy(cell).cogroup(routers.select("*", each).groupBy(cell)).applyInArrow(down, f"id long, vector {simple.simpleString()}, part long")


def _closest(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def closest(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if rows.num_rows and queries.num_rows:
            vectors, ids = matrix(rows.column("vector")), rows.column("id").to_numpy()
            for query, wanted in zip(matrix(queries.column("vector")), queries.column("id").to_pylist()):
                score = np.sqrt(((vectors - query) ** 2).sum(axis=1))
                taken: dict[int, float] = {}
                few = np.flatnonzero(score <= np.partition(score, 4 * k)[4 * k]) if len(score) > 4 * k else np.arange(len(score))
                for near in (few, np.arange(len(score))):  # all rows only if repeated ids use the near ones up
                    for i in near[np.lexsort((ids[near], score[near]))]:
                        if ids[i] != wanted and len(taken) < k:
                            taken.setdefault(int(ids[i]), float(score[i]))
                    if len(taken) == k or len(near) == len(score):
                        break
                out_query += [wanted] * len(taken)
                out_id += taken
                out_score += taken.values()
        return pa.table({"query_id": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.float64())})

    return closest


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    parts: int = PARTS,
    recall: float = RECALL,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that `is_query` selects.

    `is_query` is a condition on the column `id`. The distance is Euclidean, on the given vectors.
    """
    scratch = Scratch(table.sparkSession, "ann")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & takes_part(F.col("vector")))
    queries = rows.where(is_query).groupBy("id").agg(F.min("vector").alias("vector"))
    asked, found = lengths(queries, "vector"), None
    for length, total in lengths(rows, "vector").items():
        if length in asked:
            same = F.size("vector") == length
            near = _search_length(rows.where(same), queries.where(same), total, k, parts, recall, sample, scratch)
            found = near if found is None else found.unionAll(near)
    if found is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return single.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_length(rows: DataFrame, queries: DataFrame, total: int, k: int, parts: int, recall: float, sample: int, scratch: Scratch) -> DataFrame:
    """(query_id, vec_id, score): what each block has to offer to the queries, for vectors of one length."""
    levels = fans(total, parts)
    recall = recall ** (1 / len(levels))
    router = _train(bounded_sample(rows, sample, total, F.col("id")), levels[0], k, recall)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def homes(batches):
        for batch in batches:
            if batch.num_rows:
                home = shared.value.probabilities(matrix(batch.column(1))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int64))], names=["id", "vector", "part"])

    def routed(batches):
        for batch in batches:
            if batch.num_rows:
                chosen = [np.flatnonzero(r).tolist() for r in shared.value.routes(matrix(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.list_(pa.int64()))], names=["id", "vector", "parts"])

    kind = rows.schema["vector"].dataType.simpleString()
    index = scratch.write(rows.mapInArrow(homes, f"id long, vector {kind}, part long"), "index", merged=False)
    routes = queries.mapInArrow(routed, f"id long, vector {kind}, parts array<long>")
    routes = scratch.write(routes.select("id", "vector", F.explode("parts").alias("part")), "routes")
    for fan in levels[1:]:
        routers = scratch.write(_routers_within(index, fan, k, recall, sample), "routers")
        index, routes = (scratch.write(_descended(x, routers, fan, everywhere), name, merged=False) for x, everywhere, name in ((index, False, "index"), (routes, True, "routes")))

    near = scratch.write(_reranked(index, routes, k, scratch), "near", merged=False)
    enough = near.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
    short = scratch.write(queries.join(enough, queries["id"] == enough["query_id"], "left_anti"), "short")
    if short.isEmpty():
        return near
    # Queries whose partitions held too few rows meet all of them.
    whole = F.lit(0).cast("long").alias("part")
    return near.unionAll(_reranked(index.select("id", "vector", whole), short.select("id", "vector", whole), k, scratch))


def _reranked(index: DataFrame, routes: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, vec_id, score): the k nearest rows of each block of the partitions that a query follows."""
    # Blocks of a partition and groups of its queries: one row per partition.
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    groups = routes.groupBy("part").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("groups"))
    sizes = scratch.write(blocks.join(groups, "part"), "sizes")
    spread = F.xxhash64("id")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    placed = index.join(sizes, "part").select("id", "vector", "part", F.pmod(spread, "blocks").alias("block"), each("groups").alias("group"))
    asked = routes.join(sizes, "part").select("id", "vector", "part", each("blocks").alias("block"), F.pmod(spread, "groups").alias("group"))
    cell = ["part", "block", "group"]
    return placed.groupBy(cell).cogroup(asked.groupBy(cell)).applyInArrow(_closest(k), "query_id long, vec_id long, score double")
