"""Quality classifier: Naive Bayes support vectors on n-gram indicators.

A text is the set of its n-grams: runs of one to three bytes, hashed, and runs of two to six equal
words. Each indicator is scaled by the log-count ratio of the two classes, vectors have unit length,
and a linear hinge-loss model is fitted by dual coordinate descent. Margins become probabilities by a
logistic curve fitted on rows the model has not seen.

The classifier is fitted on a sample of labelled rows, at most `per_class` of each class (those of
lowest hash), by one task; scoring reads every whole text where it lies.

Rows and edge cases: a NULL text counts as empty and is scored by the prior and the bias; labels other
than 0 and 1, contradicting labels of one id and labels without an id are not learned from; a row
without an id counts as held out; with one class only, or none, every score is the smoothed share of
class 1; repeated rows get equal scores; an empty table gives an empty result. Of the other columns of
the input none is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed n-grams, longest n-gram of bytes and longest run of equal words.
HASH_BITS, LONGEST, LONGEST_RUN = 18, 3, 6
FEATURES = (1 << HASH_BITS) + LONGEST_RUN + 1
#: Rows of each class that the model is fitted on, at most.
PER_CLASS = 4096
#: Smoothing of counts, cost of a violated margin, passes, and weight of the plain Naive Bayes direction.
ALPHA, COST, PASSES, BLEND = 1.0, 10.0, 12, 0.25
_CHUNK = 1 << 20


class NGrams:
    """The distinct n-grams of a text, as sorted feature numbers."""

    def __init__(self) -> None:
        self.seen = np.zeros(FEATURES, dtype=bool)

    def of(self, text: str) -> np.ndarray:
        data = text.encode()
        for start in range(0, len(data), _CHUNK):
            codes = np.zeros(0, dtype=np.uint32)
            part = np.frombuffer(data[start : start + _CHUNK + LONGEST - 1], dtype=np.uint8).astype(np.uint32)
            for n in range(1, LONGEST + 1):
                if len(part) < n:
                    break
                codes = part if n == 1 else (codes[: len(part) - n + 1] << 8) | part[n - 1 :]
                self.seen[((codes + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)] = True
        words = data.split()
        same = bytes(map(eq, words, words[1:]))
        for n in range(2, LONGEST_RUN + 1):
            if b"\x01" * (n - 1) not in same:
                break
            self.seen[(1 << HASH_BITS) + n] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass
class Model:
    """Weights on scaled indicators (ratio * weight, ratio squared), bias and logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        size = math.sqrt(float(self.squares[found].sum(dtype=np.float64)))
        return float(self.weights[found].sum(dtype=np.float64)) / size + self.bias if size > 0 else self.bias

    def score(self, found: np.ndarray) -> float:
        return _sigmoid(self.slope * self.margin(found) + self.offset)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.full((2, FEATURES), ALPHA)
    for found, is_good in zip(rows, good):
        counts[int(is_good)][found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; rows have unit length and a bias feature of 1."""
    weights, bias, rng = np.zeros(FEATURES), 0.0, np.random.default_rng(seed)
    duals = np.zeros(len(rows))
    for _ in range(PASSES):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            projected = min(gradient, 0) if duals[i] == 0 else max(gradient, 0) if duals[i] == COST else gradient
            largest = max(largest, abs(projected))
            if projected:
                length = 1 + float(values[i] @ values[i])
                new = min(max(duals[i] - gradient / length, 0), COST)
                step, duals[i] = (new - duals[i]) * sign[i], new
                weights[rows[i]] += step * values[i]
                bias += step
        if largest < 1e-3:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of class 1, by Newton steps on smoothed targets."""
    ones, zeros = good.sum(), (~good).sum()
    wanted = np.where(good, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    theta = np.array([1.0, math.log((ones + 1) / (zeros + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-6 * np.eye(2), x.T @ (wanted - p))
        theta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, class_counts: tuple[int, int]) -> Model:
    """`class_counts`: rows of class 0 and 1 that the sample was drawn from."""
    prior = math.log((class_counts[1] + 1) / (class_counts[0] + 1))
    if good.all() or not good.any():
        return Model(np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.float32), 0.0, 0.0, prior)

    def weighted(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        own = [rows[i] for i in chosen]
        ratio = log_count_ratios(own, good[chosen])
        values = [ratio[f] / (np.linalg.norm(ratio[f]) or 1.0) for f in own]
        weights, bias = dual_coordinate_descent(own, values, np.where(good[chosen], 1.0, -1.0))
        used = weights[weights != 0]
        blended = (1 - BLEND) * weights + BLEND * (np.abs(used).mean() if len(used) else 0.0) * np.sign(weights)
        return (blended * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias

    order = np.random.default_rng(11).permutation(len(rows))
    unseen = order[: max(2, len(rows) // 5)]
    trial = Model(*weighted(np.setdiff1d(order, unseen)), 1.0, 0.0) if good[order[len(unseen) :]].any() and not good[order[len(unseen) :]].all() else None
    final = Model(*weighted(np.arange(len(rows))), 1.0, 0.0)
    checked = trial or final
    final.slope, final.offset = logistic_curve(np.array([checked.margin(rows[i]) for i in unseen]), good[unseen])
    # The sample holds the classes in other shares than the rows it was drawn from.
    final.offset += prior - math.log((good.sum() + 1) / ((~good).sum() + 1))
    return final


def is_held_out(row_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_ids(labels: DataFrame, per_class: int, id_col: str, label_col: str) -> tuple[DataFrame, tuple[int, int]]:
    """(doc, label) of the sample, at most `per_class` rows of each class, and the rows of each class."""
    known = labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).alias("label"))
    known = known.where(F.col("doc").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc")))
    clear = known.groupBy("doc").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("doc", F.col("label").cast("int").alias("label"))
    counts = {r.label: r.n for r in clear.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order, parts = F.xxhash64("doc"), []
    for label in (0, 1):
        # A share of the hash range that holds a little more than the sample, so that few rows are sorted.
        share = min(1.0, 1.5 * per_class / max(1, counts.get(label, 0)))
        near = F.shiftrightunsigned(order, 34) <= int(share * (1 << 30))
        parts.append(clear.where((F.col("label") == label) & near).orderBy(order, "doc").limit(per_class))
    return parts[0].unionAll(parts[1]), (counts.get(0, 0), counts.get(1, 0))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of the labelled rows; the sample's n-grams go to one task, its weights come back."""
    sample, class_counts = training_ids(labels, per_class, id_col, label_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    # The sample has at most 2 * per_class rows of two numbers: a bounded side.
    chosen = texts.join(F.broadcast(sample), "doc").select("doc", "label", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = NGrams()
        for batch in batches:
            found = [maker.of(t.as_py() or "").astype(np.int32) for t in batch.column(2)]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc", "label", "grams"])

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc")
        rows = [np.array(g.as_py(), dtype=np.int64) for g in table.column("grams")]
        model = fit(rows, np.array(table.column("label").to_pylist()) == 1, class_counts)
        return pa.table({
            "weights": pa.array([model.weights.tobytes()], pa.binary()), "squares": pa.array([model.squares.tobytes()], pa.binary()),
            "bias": [model.bias], "slope": [model.slope], "offset": [model.offset],
        })

    # An id that documents repeat counts once.
    rows = chosen.mapInArrow(grams, "doc long, label int, grams array<int>").groupBy("doc").agg(F.min(F.struct("label", "grams")).alias("r"))
    rows = rows.select("doc", "r.label", "r.grams", F.lit(0).alias("all"))
    made = rows.groupBy("all").applyInArrow(fitted, "weights binary, squares binary, bias double, slope double, offset double").collect()
    if not made:
        return fit([], np.zeros(0, dtype=bool), class_counts)
    one = made[0]
    return Model(np.frombuffer(one.weights, np.float32), np.frombuffer(one.squares, np.float32), one.bias, one.slope, one.offset)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = NGrams()
        for batch in batches:
            scores = [shared.value.score(maker.of(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(per_batch, "id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, scored and filtered in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = NGrams()
        for batch in batches:
            good = [shared.value.score(maker.of(t.as_py() or "")) >= threshold for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(per_batch, plain.schema).toDF(*docs.columns)
