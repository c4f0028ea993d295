"""Exact duplicates by a cuckoo-filter index of live digests.

Every text has a digest (SHA-256 of its normalised form in UTF-8). The index is cut into shards by
digest, and a shard is a cuckoo filter: each live digest leaves a 16-bit print in one of two buckets of
four slots, and the bucket keeps, next to the print, the content it stands for: the whole digest, the
bytes of the text, how many rows hold it, and the row that stays. A print that is met in the filter is
only a hit: it counts if the content of that slot agrees, and a text whose print meets other content
is new. If no slot can be freed within MOST_KICKS moves, the filter doubles its buckets and is filled
again from the stored keys. Digests can be taken out, which frees their slots; a text that comes back
later is new.

The index is a table, one row per live digest with its shard and slot, written to the shared folder
after each change, so that a lost executor repeats one step and a later batch goes on from it. Inside a
task equal digests are reduced to one row before they are sent, so a text that a third of all rows
share reaches its shard once per task. Shards hold about SHARD_KEYS rows each, whatever the table's size.

Rows and edge cases: a NULL text counts as empty, and equal to it; empty texts are equal to each other.
Of equal texts the row with the largest id stays; a row with a NULL id stays only if its whole group
has none; of rows that repeat both id and text one stays. An empty table gives an empty result. Other
columns are not read; `drop_copies` keeps them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch

#: Slots of a bucket, moves before a filter grows, buckets of a new filter.
SLOTS, MOST_KICKS, FIRST_BUCKETS = 4, 200, 64
#: Rows of the first table that a shard takes, about; a lower number makes more shards.
SHARD_KEYS = 4096
#: Digests that a task holds while it reduces its rows.
_HELD = 1 << 16

CONTENT = "digest binary, n_bytes long, copies long, keep_id long, keep_row long"
INDEX = f"shard int, buckets int, slot int, {CONTENT}"


class Filter:
    """A cuckoo filter whose slots keep the content behind each print."""

    def __init__(self, buckets: int = FIRST_BUCKETS) -> None:
        self.resizes = self.false_hits = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.content: list[list | None] = [None] * (buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """The print of a digest, 1 to 65,535, and its two buckets; either follows from the other and the print."""
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x9E3779B1 >> 7 & (self.buckets - 1) | 1)

    def find(self, digest: bytes) -> int | None:
        """The slot of a live digest: prints that agree are hits, verified against the content of their slot."""
        mark, *both = self._places(digest)
        for bucket in both:
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark:
                    if self.content[slot][0] == digest:
                        return slot
                    self.false_hits += 1
        return None

    def insert(self, content: list) -> None:
        """Store the content of a digest that `find` does not know."""
        while (left := self._placed(content)) is not None:
            # Overflow: twice the buckets, filled from the stored keys and the one left over.
            stored, content = [c for c in self.content if c is not None], left
            while True:
                self.resizes += 1
                self._clear(2 * self.buckets)
                if all(self._placed(c) is None for c in stored):
                    break

    def _placed(self, content: list) -> list | None:
        """Put content into a free slot, moving others to their second bucket; what found no place, if any."""
        mark, *both = self._places(content[0])
        for bucket in both:
            if self._free(bucket, mark, content):
                return None
        for kick in range(MOST_KICKS):
            slot = bucket * SLOTS + (kick + mark) % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            content, self.content[slot] = self.content[slot], content
            bucket = self._other(bucket, mark)
            if self._free(bucket, mark, content):
                return None
        return content

    def _free(self, bucket: int, mark: int, content: list) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.prints[slot]:
                self.prints[slot], self.content[slot] = mark, content
                return True
        return False

    def remove(self, digest: bytes) -> bool:
        """Take a live digest out; False if it was not live."""
        slot = self.find(digest)
        if slot is None:
            return False
        self.prints[slot], self.content[slot] = 0, None
        return True

    def add(self, row: list) -> None:
        """Count rows of one digest: new content, or more copies of what is live."""
        slot = self.find(row[0])
        if slot is None:
            self.insert(row)
            return
        live = self.content[slot]
        if live[1] != row[1]:
            raise ValueError("texts of unlike length share a digest")
        live[2] += row[2]
        live[3:5] = _later(live[3:5], row[3:5])

    @classmethod
    def stored(cls, index: pa.Table) -> Filter:
        """The filter of a shard as it was written: prints follow from the digests, so nothing is moved."""
        if not index.num_rows:
            return cls()
        out = cls(index.column("buckets")[0].as_py())
        columns = [index.column(c).to_pylist() for c in ("slot", "digest", "n_bytes", "copies", "keep_id", "keep_row")]
        for slot, *content in zip(*columns):
            out.prints[slot], out.content[slot] = out._places(content[0])[0], content
        return out

    def table(self, shard: int) -> pa.Table:
        live = [(slot, *content) for slot, content in enumerate(self.content) if content is not None]
        slot, digest, *numbers = zip(*live) if live else ((),) * 6
        names = ["shard", "buckets", "slot", "digest", "n_bytes", "copies", "keep_id", "keep_row"]
        ints = [pa.array([x] * len(live), pa.int32()) for x in (shard, self.buckets)]
        return pa.table([*ints, pa.array(slot, pa.int32()), pa.array(digest, pa.binary()), *[pa.array(n, pa.int64()) for n in numbers]], names=names)


def _later(one: list, two: list) -> list:
    """The larger of two (id, row): a row without an id comes before all others; rows break ties, the first is the later."""
    return max(one, two, key=lambda x: (x[0] is not None, x[0] or 0, -x[1]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None, row: Column | None = None) -> DataFrame:
    """(row, id, digest, n_bytes) of every row. `normalise` maps the text column; by default texts stay as they are.

    `row` tells rows apart. The default numbers hold as long as the frame is not planned anew: write it before it is read twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = (normalise(text) if normalise else text).cast("binary")  # its UTF-8 bytes as they are
    number = F.monotonically_increasing_id() if row is None else row
    hashed = F.unhex(F.sha2(text, 256)).alias("digest")
    return docs.select(number.alias("row"), F.col(id_col).cast("long").alias("id"), hashed, F.octet_length(text).cast("long").alias("n_bytes"))


def _reduced(rows: DataFrame) -> DataFrame:
    """CONTENT of each digest once per task, or a few times in a task of very many digests."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def out() -> pa.RecordBatch:
            columns = list(zip(*held.values())) or [()] * 5
            kinds = [pa.binary(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["digest", "n_bytes", "copies", "keep_id", "keep_row"])

        for batch in batches:
            for row, row_id, digest, size in zip(*[batch.column(c).to_pylist() for c in ("row", "id", "digest", "n_bytes")]):
                known = held.get(digest)
                if known is None:
                    held[digest] = [digest, size, 1, row_id, row]
                else:
                    known[2] += 1
                    known[3:5] = _later(known[3:5], [row_id, row])
            if len(held) >= _HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    return rows.select("row", "id", "digest", "n_bytes").mapInArrow(per_task, CONTENT)


def _shard(shards: int) -> Column:
    """The shard of a digest, by bytes that its filter does not use."""
    return F.pmod(F.conv(F.hex(F.substring("digest", 11, 6)), 16, 10).cast("long"), F.lit(shards)).cast("int")


class Index:
    """The live digests of all rows inserted and not deleted since: `table` has the columns of INDEX.

    Each change writes a new table and leaves the one before to its readers.
    """

    def __init__(self, scratch: Scratch, shards: int, table: DataFrame | None = None) -> None:
        self.scratch, self.shards = scratch, shards
        self.table = scratch.spark.createDataFrame([], INDEX) if table is None else table

    def _changed(self, incoming: DataFrame, step: Callable[[Filter, pa.Table], None]) -> Index:
        def change(key: tuple, stored: pa.Table, rows: pa.Table) -> pa.Table:
            live = Filter.stored(stored)
            step(live, rows)
            return live.table(key[0].as_py())

        sides = self.table.groupBy("shard"), incoming.withColumn("shard", _shard(self.shards)).groupBy("shard")
        return Index(self.scratch, self.shards, self.scratch.write(sides[0].cogroup(sides[1]).applyInArrow(change, INDEX), "index"))

    def inserted(self, rows: DataFrame) -> Index:
        """The index after rows of `digests` have come in. Row numbers must not repeat those inserted before."""

        def step(live: Filter, rows: pa.Table) -> None:
            for row in zip(*[rows.column(c).to_pylist() for c in ("digest", "n_bytes", "copies", "keep_id", "keep_row")]):
                live.add(list(row))

        return self._changed(_reduced(rows), step)

    def deleted(self, rows: DataFrame) -> Index:
        """The index without the texts of `rows` (digest), all copies of them; digests that are not live are passed over."""

        def step(live: Filter, rows: pa.Table) -> None:
            for digest in rows.column("digest").to_pylist():
                live.remove(digest)

        return self._changed(rows.select("digest").distinct(), step)

    def found(self, rows: DataFrame) -> DataFrame:
        """`rows` of `digests` that are live, with keep_id, keep_row and copies."""
        held = self.table.select(F.col("digest").alias("_digest"), "copies", "keep_id", "keep_row")
        return rows.join(held, rows["digest"] == held["_digest"]).drop("_digest")


def build(rows: DataFrame, scratch: Scratch, shard_keys: int = SHARD_KEYS) -> Index:
    """An index of written rows of `digests`, with shards in proportion to the rows."""
    return Index(scratch, max(1, -(-rows.count() // shard_keys))).inserted(rows)


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, n_bytes) for every row of `docs`."""
    scratch = Scratch(docs.sparkSession, "cuckoo")
    rows = scratch.write(digests(docs, id_col, text_col, normalise), "rows", merged=False)
    known = build(rows, scratch).found(rows)
    return known.select("id", "keep_id", F.col("copies").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "digest", "n_bytes")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. The rows are written once and keep their numbers."""
    scratch = Scratch(docs.sparkSession, "cuckoo-drop")
    numbered = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    numbered = scratch.write(numbered, "numbered", merged=False)
    rows = digests(numbered, f"doc.`{id_col}`", f"doc.`{text_col}`", normalise, F.col("row"))
    rows = scratch.write(rows, "rows", merged=False)
    stays = build(rows, scratch).table.select(F.col("keep_row").alias("_stays"))
    return numbered.join(stays.hint("merge"), numbered["row"] == stays["_stays"]).select("doc.*")
