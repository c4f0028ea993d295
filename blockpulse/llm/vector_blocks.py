"""Vectors in tasks of bounded size: which rows take part, bounded samples, and pairs of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers made of components are at most this far from 0, so that a long holds them.
LARGEST = float(1 << 62)
#: Rows of one matrix.
ROWS = 4096


def takes_part(vector: Column) -> Column:
    """True for a vector that is not NULL, not all zero, and has finite components only."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(wide, lambda x: x != 0), F.lit(False))


def bounded_sample(rows: DataFrame, most: int, total: int, key: Column) -> DataFrame:
    """At most `most` of `total` rows: those whose key has the lowest hashes.

    A first filter keeps a share of the hash range that holds a little more than the sample, so that
    few rows are sorted, however many there are.
    """
    share = min(1.0, 1.5 * most / max(1, total))
    order = F.xxhash64(key)
    return rows.where(F.shiftrightunsigned(order, 34) <= int(share * (1 << 30))).orderBy(order, key).limit(most)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    if len(column) == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def lengths(rows: DataFrame, vector: str) -> dict[int, int]:
    """How many vectors there are of each number of components."""
    return {r.size: r.rows for r in rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("rows")).orderBy("size").collect()}


def integers(vector: Column, steps: int, offset: int = 0, below: Column | float = LARGEST) -> Column:
    """floor(steps * c) + offset of every component, or NULL for a vector that is NULL, empty, or holds NULL or non-finite components or any not `below` a limit."""
    scaled = F.transform(vector, lambda c: c.cast("double") * steps)
    bad = F.exists(scaled, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= below))
    whole = F.transform(scaled, lambda c: F.floor(c) + F.lit(offset).cast("long"))
    return F.when(~bad & (F.size(vector) > 0), whole)


def matrices(batches: Iterator[pa.RecordBatch], column: int, by: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """At most ROWS rows at a time whose lists have one length (or one value of the column `by`), with those as a matrix."""
    for batch in batches:
        kinds = (batch.column(column).value_lengths() if by is None else batch.column(by)).to_numpy(zero_copy_only=False)
        for kind in np.unique(kinds):
            same = batch if (kinds == kind).all() else batch.filter(pa.array(kinds == kind))
            for start in range(0, same.num_rows, ROWS):
                part = same.slice(start, ROWS)
                yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def fits_long(*factors: int) -> bool:
    """Whether a product of magnitudes stays within a long."""
    product = 1
    for f in factors:
        product *= int(f)
    return product < 1 << 63


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
