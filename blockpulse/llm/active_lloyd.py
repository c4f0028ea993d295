"""Product codes of vectors, fitted by Lloyd's rounds that compare moved entries only.

Components become integers, floor(4096 * x), and a vector is cut into consecutive parts, each with a
codebook of its own. A round gives every part its nearest entry and then replaces every entry by the
floored mean of its parts. Everything is integer arithmetic, so results don't depend on the order of
rows or tasks.

Each row keeps, beside its vector, the entry of every part and the exact squared distance to it. Where
that entry did not move in the last update, the stored distance still holds, and so does that no entry
which stayed is nearer: such a part is compared with the moved entries only. Other parts are compared
with all entries. Both ways take the smallest (distance, index), so ties go to the lower index. A round
in which no entry moves ends the fit, since all later ones would repeat it.

The state of the rows is written after each round to the shared folder. Sums and counts per entry are
added up in the tasks and then by Spark; only the codebooks, entries x components integers for each
length of vectors, go through the driver.

Rows and edge cases: vectors that are NULL, empty, or hold NULL or non-finite components are left out, and
so are those with components so large (beyond 46,340 for 64 components) that a squared distance may not
fit a long. Vectors of each length have codebooks of their own. A length that the parts don't divide
has longer parts first; parts without components have code 0 and error 0. The first entries are those
of the smallest ids, NULL ids last, equal ids by vector; fewer rows give fewer entries. Repeated rows
count each. A label's error beyond a long is NULL. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch
from blockpulse.llm.vector_blocks import integers, matrices

#: Steps per unit of the integers, parts of a vector, entries of a codebook, rounds.
STEPS, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Differences that are held at once.
_CELLS = 1 << 20

#: book[part] is a matrix, a row for each entry.
Book = list[np.ndarray]

STATE = ["id", "label", "width", "x", "codes", "errors"]


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    ends = np.cumsum([0, *[width // parts + (p < width % parts) for p in range(parts)]])
    return [(int(a), int(b)) for a, b in zip(ends, ends[1:])]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every entry, a bounded number of differences at a time."""
    out = np.zeros((len(x), len(entries)), np.int64)
    step = max(1, _CELLS // max(1, entries.size))
    for i in range(0, len(x), step):
        apart = x[i : i + step, None, :] - entries[None]
        out[i : i + step] = np.einsum("ijk,ijk->ij", apart, apart)
    return out


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None, error: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(code, error, compared): the nearest entry of each row of one part, its squared distance, and how many distances were worked out.

    `code` and `error` are those of the last round, None in the first; `moved` marks the entries replaced since.
    """
    rescan = np.ones(len(x), bool) if code is None else moved[code]
    out_code, out_error = (np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)) if code is None else (code.astype(np.int64), error.copy())
    far = distances(x[rescan], entries)
    out_code[rescan] = far.argmin(axis=1)  # the first of equals
    out_error[rescan] = far.min(axis=1)
    compared, stay = far.size, np.flatnonzero(~rescan)
    if len(stay) and moved.any():
        far = distances(x[stay], entries[moved])
        near, index = far.min(axis=1), np.flatnonzero(moved)[far.argmin(axis=1)]
        better = (near < out_error[stay]) | ((near == out_error[stay]) & (index < out_code[stay]))
        out_code[stay[better]], out_error[stay[better]] = index[better], near[better]
        compared += far.size
    return out_code, out_error, compared


def first_books(rows: DataFrame, parts: int, entries: int) -> dict[int, Book]:
    """The first rows of each length cut into parts. Spark keeps that many rows per task before it moves any."""
    order = Window.partitionBy("width").orderBy(F.col("id").asc_nulls_last(), "x")
    first = rows.select("width", "id", "x").withColumn("place", F.row_number().over(order)).where(F.col("place") <= entries)
    found: dict[int, list] = {}
    for r in first.orderBy("width", "place").collect():
        found.setdefault(r.width, []).append(r.x)
    return {w: [np.array([v[a:b] for v in x], np.int64).reshape(len(x), b - a) for a, b in part_bounds(w, parts)] for w, x in found.items()}


def _assigned(state: DataFrame, books: dict[int, Book], moved: dict[int, list[np.ndarray]], parts: int) -> DataFrame:
    """`state` (id, label, width, x, codes, errors) with the entries of this round."""
    shared = state.sparkSession.sparkContext.broadcast((books, moved))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moved = shared.value
        for part, x in matrices(batches, 3):
            rows, width = x.shape
            codes, errors = (None if c.null_count else c.flatten().to_numpy(zero_copy_only=False).reshape(rows, parts) for c in part.columns[4:])
            new = np.zeros((2, rows, parts), np.int64)
            for p, (a, b) in enumerate(part_bounds(width, parts)):
                before = (None, None) if codes is None else (codes[:, p], errors[:, p])
                new[0, :, p], new[1, :, p], _ = assign(x[:, a:b], books[width][p], moved[width][p], *before)
            ends = pa.array(np.arange(rows + 1) * parts, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(n.ravel(), kind)) for n, kind in zip(new, (pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], *lists], names=STATE)

    return state.mapInArrow(per_batch, state.schema)


def entry_sums(state: DataFrame, books: dict[int, Book], parts: int) -> DataFrame:
    """(width, part, entry, place, n, total): rows of each entry, and the sum of each of its components."""
    entries = {w: len(book[0]) for w, book in books.items()}

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for part, x in matrices(batches, 0):
            width, k = x.shape[1], entries[x.shape[1]]
            count, total = held.setdefault(width, (np.zeros((parts, k), np.int64), np.zeros((k, width), np.int64)))
            codes = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(x), parts)
            for p, (a, b) in enumerate(part_bounds(width, parts)):
                count[p] += np.bincount(codes[:, p], minlength=k)
                np.add.at(total[:, a:b], codes[:, p], x[:, a:b])
        for width, (count, total) in held.items():
            for p, (a, b) in enumerate(part_bounds(width, parts)):
                used = np.flatnonzero(count[p])
                numbers = [pa.array(np.full(len(used), v), pa.int32()) for v in (width, p)]
                sums = pa.array([total[e, a:b].tolist() for e in used], pa.list_(pa.int64()))
                columns = [*numbers, pa.array(used, pa.int32()), pa.array(count[p, used], pa.int64()), sums]
                yield pa.RecordBatch.from_arrays(columns, names=["width", "part", "entry", "n", "sums"])

    partial = state.select("x", "codes").mapInArrow(per_task, "width int, part int, entry int, n long, sums array<long>")
    placed = partial.select("width", "part", "entry", "n", F.posexplode("sums").alias("place", "s"))
    return placed.groupBy("width", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("total"))


def updated(books: dict[int, Book], sums: DataFrame) -> tuple[dict[int, Book], dict[int, list[np.ndarray]]]:
    """The books after a round, and which entries moved. Entries without rows stay."""
    new = {w: [e.copy() for e in book] for w, book in books.items()}
    for r in sums.collect():
        new[r.width][r.part][r.entry, r.place] = int(r.total) // r.n
    return new, {w: [(a != b).any(axis=1) for a, b in zip(new[w], books[w])] for w in books}


def digest(book: Book) -> str:
    numbers = ",".join(str(v) for entries in book for entry in entries.tolist() for v in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, steps: int = STEPS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> DataFrame:
    """(id, codes, error, label_error, codebooks_sha256) for every row that takes part.

    `error` is the squared distance to the coded vector in steps; `label_error` its sum over rows of an
    equal label, NULL labels together (over all rows where `label_col` is None).
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "lloyd")
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    # The squared distance of two such vectors fits a long.
    below = F.sqrt(F.lit(2.0**61) / F.size(vector_col))
    rows = table.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), integers(F.col(vector_col), steps, below=below).alias("x")).where("x IS NOT NULL")
    unknown = F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("array<long>").alias("errors")
    state = scratch.write(rows.select("id", "label", F.size("x").alias("width"), "x", *unknown), "state", merged=False)

    books = first_books(state, parts, entries)
    moved = {w: [np.ones(len(e), bool) for e in book] for w, book in books.items()}
    for step in range(rounds + 1):
        after = scratch.write(_assigned(state, books, moved, parts), "state", merged=False)
        scratch.drop(state)
        state = after
        if step < rounds:
            books, moved = updated(books, entry_sums(state, books, parts))
            if not any(m.any() for book in moved.values() for m in book):
                break

    error = F.aggregate("errors", F.lit(0).cast("long"), lambda a, b: a + b)
    # One row per length.
    digests = spark.createDataFrame([(w, digest(book)) for w, book in books.items()], "width int, codebooks_sha256 string")
    done = state.select("id", "label", "width", "codes", error.alias("error"))
    by_label = scratch.write(done.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "labels")
    joined = done.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).join(F.broadcast(digests), "width")
    return joined.select("id", "codes", "error", "label_error", "codebooks_sha256")
