"""Whitening of vectors by a covariance that is weighted with multiplicities.

Components become integers, floor(64 * c) + 1000000, and equal integer vectors are one: their number is
the weight of that vector in the fit (or 1, if copies should not count). Sums are exact integers. Each
distinct vector is centred, multiplied out once with its weight (a matrix product per batch of rows,
summed by Spark), and the eigenvectors of the covariance whiten it once; the rows then get the result
of their vector by a join.

A model (sums, components, eigenvalues) has a size fixed by the length of the vectors, 33 numbers a
component of a vector, and goes through the driver; vectors, counts and products stay with Spark.

Rows and edge cases: vectors that are NULL, or hold NULL, non-finite or such large components that their
integer does not fit a long, are left out; so are empty vectors, which have no component. Vectors of
each length have a fit of their own. A zero vector takes part. Repeated rows count as often as they
occur; rows with a NULL id take part and keep the NULL. Components along which the vectors don't vary
cannot be whitened: `whitened` is NULL there, and `explained` is 0 (NULL if nothing varies at all). A
deviation beyond a long is NULL. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch
from blockpulse.llm.vector_blocks import fits_long, integers, largest, matrices

#: Steps per unit and offset of the integer vectors; components returned, at most.
STEPS, OFFSET, COMPONENTS = 64, 1_000_000, 32


@dataclass
class Fit:
    """What whitens the vectors of one length; eigenvalues fall, one row of `axes` belongs to each."""

    n: int
    sums: list[int]
    axes: np.ndarray | None = None
    values: np.ndarray | None = None

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        safe = fits_long(2 * self.n, max(largest(x), max(map(abs, self.sums)) // self.n + 1))
        kind = np.int64 if safe else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The squares of n * x - S summed over the components; None beyond a long."""
        top = self.numerators(x)
        if top.dtype == object or not fits_long(x.shape[1], largest(top), largest(top)):
            return [d if d < 1 << 63 else None for d in (sum(int(v) ** 2 for v in row) for row in top)]
        return (top * top).sum(axis=1).tolist()


def _weighted_sums(distinct: DataFrame) -> dict[int, Fit]:
    """n and the exact sums of each length. Tasks add up their rows; Spark adds up the tasks' sums."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part, x in matrices(batches, 0):
            w = part.column(1).to_numpy()
            if not fits_long(largest(x), int(w.sum()) + 1):
                x, w = x.astype(object), w.astype(object)
            n, sums = held.get(x.shape[1], (0, [0] * x.shape[1]))
            held[x.shape[1]] = [n + int(w.sum()), [a + int(b) for a, b in zip(sums, (x * w[:, None]).sum(axis=0))]]
        if held:
            texts = [[str(s) for s in sums] for _, sums in held.values()]
            columns = [pa.array([*held], pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["width", "n", "sums"])

    partial = distinct.select("x", "w").mapInArrow(per_task, "width int, n long, sums array<string>")
    placed = partial.select("width", "n", F.posexplode("sums").alias("place", "s"))
    summed = placed.groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    fits: dict[int, Fit] = {}
    for r in summed.orderBy("width", "place").collect():
        fits.setdefault(r.width, Fit(int(r.n), [])).sums.append(int(r.s))
    return fits


def _products(rows: DataFrame, weights: str, vectors: str, centre, scratch: Scratch) -> DataFrame:
    """(width, n, products): weighted outer products of centred vectors, summed. `centre` maps a width and a matrix to the centred matrix."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part, x in matrices(batches, 2, by=0):
            width, w = part.column(0)[0].as_py(), part.column(1).to_numpy().astype(np.float64)
            y = centre(width, x)
            held[width] = held.get(width, 0.0) + (y * w[:, None]).T @ y
        if held:
            flat = pa.array([m.ravel() for m in held.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int32()), flat], names=["width", "products"])

    width = F.col("width") if "width" in rows.columns else F.size(vectors).alias("width")
    partial = scratch.write(rows.select(width, weights, vectors).mapInArrow(per_task, "width int, products array<double>"), "products", merged=False)
    # The summarizer keeps a running mean, which is turned back into a sum.
    added = partial.groupBy("width").agg(F.count("*").alias("tasks"), Summarizer.mean(array_to_vector("products")).alias("mean"))
    return added.select("width", F.transform(vector_to_array("mean"), lambda m: m * F.col("tasks")).alias("products"))


def _eigen(products: DataFrame, sizes: dict[int, int], components: int) -> DataFrame:
    """(width, trace, axes, values): the leading eigenvectors of each covariance, found by executors."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, flat in zip(*[c.to_pylist() for c in batch.columns]):
                covariance = np.array(flat).reshape(width, width) / sizes[width]
                values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
                order = np.argsort(-values, kind="stable")[:components]
                row = {"width": width, "trace": float(np.trace(covariance)), "axes": axes[:, order].T.ravel(), "values": values[order]}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("width", pa.int32()), ("trace", pa.float64()), ("axes", pa.list_(pa.float64())), ("values", pa.list_(pa.float64()))]))

    return products.mapInArrow(solved, "width int, trace double, axes array<double>, values array<double>")


def whiten(
    table: DataFrame, components: int = COMPONENTS, copies_count: bool = True, steps: int = STEPS, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for every row that takes part.

    `whitened` and `explained` are arrays, one entry per component. `identity_error` is one value: how far
    the covariance of all that was whitened is from the identity, at most. `copies_count`: whether a
    vector weighs its number of rows in the fit, or 1.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = table.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), steps, offset).alias("x"))
    rows = scratch.write(rows.where("x IS NOT NULL"), "rows", merged=False)
    weight = F.count("*") if copies_count else F.first(F.lit(1).cast("long"))
    distinct = scratch.write(rows.groupBy("x").agg(weight.alias("w")), "distinct")

    fits = _weighted_sums(distinct)
    sizes = {width: fit.n for width, fit in fits.items()}
    sums = spark.sparkContext.broadcast(fits)
    products = _products(distinct, "w", "x", lambda width, x: sums.value[width].centred(x), scratch)
    solved = scratch.write(_eigen(products, sizes, components), "eigen")
    explained: dict[int, list] = {}
    for r in solved.collect():
        fit, values = fits[r.width], np.array(r["values"])
        # Rounding leaves about this much of the trace where nothing varies.
        varies = values > max(r.trace, 0) * r.width * 1e-14
        fit.axes, fit.values = np.array(r.axes).reshape(-1, r.width), np.where(varies, values, 0.0)
        explained[r.width] = [float(v / r.trace) for v in fit.values] if r.trace > 0 else [None] * len(values)

    models = spark.sparkContext.broadcast(fits)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, 0):
            fit = models.value[x.shape[1]]
            varies = fit.values > 0
            z = np.zeros((len(x), len(varies)))
            z[:, varies] = fit.centred(x) @ (fit.axes[varies] / np.sqrt(fit.values[varies])[:, None]).T
            flat = pa.array(z.ravel(), pa.float64(), mask=np.tile(~varies, len(x)))
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(varies), pa.int32()), flat)
            width = pa.array(np.full(len(x), x.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), width, pa.array(fit.deviations(x), pa.int64()), arrays], names=["x", "w", "width", "deviation", "whitened"])

    done = distinct.select("x", "w").mapInArrow(whitened, "x array<long>, w long, width int, deviation long, whitened array<double>")
    done = scratch.write(done, "whitened", merged=False)
    error = _identity_error(done, {width: fit.values > 0 for width, fit in fits.items()}, sizes, scratch)
    scratch.drop(solved)

    # One row per length.
    known = spark.createDataFrame([(w, sizes[w], explained[w]) for w in fits], "width int, n long, explained array<double>")
    joined = rows.join(done.select("x", "width", "deviation", "whitened"), "x").join(F.broadcast(known), "width")
    return joined.select("id", "n", "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))


def _identity_error(done: DataFrame, varies: dict[int, np.ndarray], sizes: dict[int, int], scratch: Scratch) -> float | None:
    """The largest absolute entry of the whitened covariance less the identity, over all lengths."""
    spark = done.sparkSession
    full = done.select("width", "w", F.filter("whitened", lambda z: z.isNotNull()).alias("z")).where("size(z) > 0")
    moments = full.groupBy("width").agg(Summarizer.mean(array_to_vector("z"), F.col("w").cast("double")).alias("mean"))
    means = spark.sparkContext.broadcast({r.width: np.array(r["mean"]) for r in moments.collect()})
    errors = []
    for r in _products(full, "w", "z", lambda width, z: z - means.value[width], scratch).collect():
        k = int(varies[r.width].sum())
        errors.append(np.abs(np.array(r.products).reshape(k, k) / sizes[r.width] - np.eye(k)).max())
    return float(max(errors)) if errors else None


def by_component(found: DataFrame) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per component, from 1."""
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "part")
    flat = found.select("id", "n", "deviation", "identity_error", parts)
    return flat.select("id", (F.col("place") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained", "identity_error")
