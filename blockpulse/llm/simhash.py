"""SimHash near-duplicates: fingerprints of word shingles, joined on shared blocks of bits.

Rows and edge cases: a NULL text counts as empty, an empty text has fingerprint 0 and links like any
other, repeated rows share a class, an empty table gives an empty result. A row with a NULL id takes
part and gets the smallest known id of its class, or NULL if the class has none. `near_duplicates` does
not read other columns of the input, `keep_first` keeps them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.llm.components import smallest_ids
from blockpulse.llm.scratch import Scratch

SEED = 42
BITS = 64
#: Shingle words, largest bit distance of a link and number of blocks a fingerprint is split into.
WIDTH, DISTANCE, BLOCKS = 3, 2, 4
#: Buckets up to this many fingerprints are compared pair by pair; larger ones meet at their midpoints.
PAIR_BUCKET = 256
_CHUNK = 1 << 15


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The unsigned 64-bit fingerprint: a bit is set if it is set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
        total = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, _CHUNK):
        size = min(_CHUNK, total - start)
        hashes = np.fromiter((digest(s, SEED) for s, _ in zip(shingles, range(size))), dtype=np.uint64, count=size)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """(id, fp): the signed long form of each row's fingerprint; with `mark` (id, mark, fp), that binary beside it."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), width) for t in batch.column("text")], dtype=np.uint64)
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(values.view(np.int64))], names=[*kept, "fp"])

    also = [] if mark is None else [mark.alias("mark")]
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), *also, F.col(text_col).alias("text"))
    return narrow.mapInArrow(per_batch, "id long, mark binary, fp long" if also else "id long, fp long")


def row_mark(docs: DataFrame) -> Column:
    """A 128-bit digest of a whole row, all columns: equal for equal rows only."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return F.unhex(F.md5(whole))


def _block_masks(blocks: int, kept: int) -> list[int]:
    """Signed masks of every choice of `kept` out of `blocks` runs of bits."""
    sizes = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    starts = np.cumsum([0, *sizes])
    runs = [((1 << sizes[i]) - 1) << int(starts[i]) for i in range(blocks)]
    masks = [sum(runs[i] for i in choice) for choice in combinations(range(blocks), kept)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _bit_distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_pairs(prints: DataFrame, scratch: Scratch, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): links between different fingerprints that join every pair within `distance` bits.

    `prints` holds distinct fingerprints (fp). Two that differ in at most `distance` bits agree on at
    least `blocks - distance` blocks, so some choice of that many blocks is a join key both share.
    Small buckets are compared pair by pair. In a larger bucket every member is sent to all values
    within half the distance; members that meet at a value are close to each other, and linking each
    to the smallest there joins the same classes with rows in proportion to the bucket. Every link is
    verified by its Hamming distance.
    """
    if blocks <= distance or distance % 2:
        raise ValueError("the distance must be even and below the number of blocks")
    masks = _block_masks(blocks, blocks - distance)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.inline(keys))
    sizes = scratch.write(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = scratch.write(keyed.join(sizes, ["choice", "key"]), "bucket-members")

    small = members.where(F.col("n") <= PAIR_BUCKET)
    left = small.select("choice", "key", F.col("fp").alias("a"))
    right = small.select("choice", "key", F.col("fp").alias("b"))
    paired = left.join(right, ["choice", "key"]).where("a < b")

    links = paired.select("a", "b")

    met = None
    if not sizes.where(F.col("n") > PAIR_BUCKET).isEmpty():
        large = members.where(F.col("n") > PAIR_BUCKET).select("fp").distinct()
        met = scratch.write(_meetings(large, distance), "meetings")
        centres = scratch.write(met.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "centres")
        links = links.unionAll(met.join(centres, "value").where("a < fp").select("a", F.col("fp").alias("b")))

    out = scratch.write(links.where(_bit_distance("a", "b") <= distance).distinct(), "close")
    scratch.drop(sizes, members, *([met, centres] if met else []))
    return out


def _meetings(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, value): each fingerprint at every value within half the distance, where close ones meet."""
    signed = [1 << i if i < BITS - 1 else -(1 << i) for i in range(BITS)]
    choices = [c for count in range(distance // 2 + 1) for c in combinations(signed, count)]
    values = F.array(*[F.col("fp").bitwiseXOR(F.lit(sum(c))) for c in choices])
    return prints.select("fp", F.explode(values).alias("value"))


def _classes(rows: DataFrame, scratch: Scratch, distance: int, blocks: int) -> DataFrame:
    """(node, root, component_id) for every distinct fingerprint of `rows`."""
    prints = scratch.write(rows.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    links = close_pairs(prints.select("fp"), scratch, distance, blocks)
    classes = smallest_ids(prints.select(F.col("fp").alias("node"), "id"), links, scratch)
    scratch.drop(prints, links)
    return classes


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest id reachable by links."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, width, id_col, text_col), "fingerprints", merged=False)
    classes = _classes(rows, scratch, distance, blocks)
    return rows.join(classes, rows.fp == classes.node).select("id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """A signed fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(
    docs: DataFrame,
    width: int = WIDTH,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` without near copies: one row for each class, that with its smallest id.

    Rows without an id come last. Of rows that share the smallest id the one with the lowest digest of
    the whole row stays, so reruns agree; equal rows are reduced to one, and only they are aggregated as
    whole rows. All columns stay, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    rows = scratch.write(fingerprints(docs, width, id_col, text_col, row_mark(docs)), "fingerprints", merged=False)
    classes = _classes(rows, scratch, distance, blocks)
    found = rows.join(classes, rows.fp == classes.node).groupBy("root", "id", "mark").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark", "n")).alias("first")
    kept = scratch.write(found.groupBy("root").agg(first).select(F.col("first.mark").alias("kept"), "first.n"), "kept")

    # Merged at every size: marks grow with the data, so neither side is one to broadcast. Equal texts
    # are of one class, so a mark is kept for one class only.
    whole = docs.select(F.struct("*").alias("doc"), row_mark(docs).alias("mark"))
    joined = whole.join(kept.hint("merge"), F.col("mark") == F.col("kept"))
    if kept.where("n > 1").isEmpty():
        return joined.select("doc.*")
    repeated = joined.where("n > 1").groupBy("mark").agg(F.first("doc").alias("doc"))
    return joined.where("n = 1").select("doc").unionAll(repeated.select("doc")).select("doc.*")
