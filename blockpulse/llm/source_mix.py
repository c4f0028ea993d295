"""Mixing sources to target weights by thresholds on a hash.

Each document has a 60-bit hash. Sizes are summed by source and hash bucket; the running sums show the
bucket where a source's budget runs out, and only the rows of that bucket are summed again, by the next
bits of the hash, until it holds at most one hash. A document is taken if its hash lies below the
threshold of its source: a filter, no sort, and the same rows on every run. Rows that repeat an id are
numbered, and all but the first hash by their number too, so that they are taken one by one; only such
rows are moved for that. All work is DataFrame functions.

Rows and edge cases: a NULL text has size 0; a NULL source is a source of its own, the last; a NULL id
hashes by its text; rows of one id are numbered in the order of source (NULL first), size and, in `mix`, a
digest of the row; sources of size 0 have target 0; an empty table gives an empty result. Other columns of
the input may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.llm.repeats import numbered
from blockpulse.llm.scratch import Scratch

#: Weights of the sources in the order of their names, repeating; most copies of a document.
WEIGHTS, MOST_COPIES = (1, 2, 3), 3
#: Bits of the hash, and bits told apart by one histogram.
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(row_id: Column, text: Column) -> Column:
    """A hash of HASH_BITS bits of the id, or of the text where there is no id."""
    named = F.coalesce(row_id.cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """`sizes` (source, source_size, source_rows; one row per source) with the target of each source.

    All sizes are shared by weight; a source gets at most `most` times its size, and what it cannot
    take is shared again among the others. Sources reach their limit in the order of size per weight,
    so the last one that does is found by running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int"))
    weighted = sizes.withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy()
    poorest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = poorest.rowsBetween(Window.unboundedPreceding, -1)
    left_size = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = weighted.withColumn("_left", left_size.cast("double")).withColumn("_weights", left_weight.cast("double"))
    full = F.col("weight") * F.col("_left") > most * F.col("source_size") * F.col("_weights")
    # The first source that is not full fixes the share of one unit of weight for all after it.
    first = F.first(F.when(~full, F.struct("_left", "_weights")), ignorenulls=True).over(poorest.rowsBetween(Window.unboundedPreceding, 0))
    share = F.col("_first._left") * F.col("weight") / F.col("_first._weights")
    limit = (most * F.col("source_size")).cast("double")
    target = F.when(F.col("_first").isNull(), limit).otherwise(F.least(share, limit))
    return shared.withColumn("_first", first).select("source", "source_size", "source_rows", target.alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, source_size, target, copies, below): a document gets `copies`, and one more if hash < below.

    `rows` holds (source, size, hash). The budget of the extra copies is target - copies * source_size;
    documents of lowest hash are taken while their sum stays within half a document of it. [lo, hi) is
    the boundary bucket of a source, `spent` the sizes below it, `size` and `rows` what it holds.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("copies", copies).select(
        "source", "source_size", "target", "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("lo"), F.lit(1 << HASH_BITS).alias("hi"),
        F.lit(0).cast("long").alias("spent"), F.col("source_size").alias("size"), F.col("source_rows").alias("rows"),
    )
    state = scratch.write(state, "budgets")
    for level in range(HASH_BITS // LEVEL_BITS):
        open_ = state.where("budget > 0 and rows > 1")
        if open_.isEmpty():
            break
        width = 1 << (HASH_BITS - LEVEL_BITS * (level + 1))
        inside = open_.select(F.col("source").alias("_source"), "lo", "hi", "spent", "budget")
        held = rows.join(inside, rows["source"].eqNullSafe(F.col("_source"))).where("hash >= lo and hash < hi")
        bucket = F.shiftright("hash", width.bit_length() - 1)
        counts = held.groupBy("_source", "spent", "budget", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        running = Window.partitionBy("_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        begun = counts.withColumn("spent", F.col("spent") + F.coalesce(F.sum("size").over(running), F.lit(0)))
        # The last bucket that begins within the budget is the one where it runs out.
        last = begun.where("spent <= budget").groupBy("_source").agg(F.max(F.struct("bucket", "spent", "size", "rows")).alias("at"))
        moved = state.join(last, state["source"].eqNullSafe(last["_source"]) & (F.col("budget") > 0) & (state["rows"] > 1), "left")
        lo = F.col("at.bucket") * width
        new = {"lo": lo, "hi": lo + width, "spent": F.col("at.spent"), "size": F.col("at.size"), "rows": F.col("at.rows")}
        step = scratch.write(moved.select("source", "source_size", "target", "copies", "budget", *[F.coalesce(v, state[c]).alias(c) for c, v in new.items()]), "budgets")
        scratch.drop(state)
        state = step
    # What is left of a boundary has one hash: it is taken if that comes nearer to the budget.
    nearer = 2 * (F.col("budget") - F.col("spent")) >= F.col("size")
    below = F.when(F.col("budget") <= 0, 0).when(nearer, F.col("hi")).otherwise(F.col("lo"))
    return state.select("source", "source_size", "target", "copies", below.cast("long").alias("below"))


def _apart(rows: DataFrame, repeated: DataFrame, scratch: Scratch, order: tuple[str, ...]) -> DataFrame:
    """`rows` with a hash of its own for each row of a hash in `repeated`."""
    again = scratch.write(rows.join(repeated, "hash").select(*rows.columns), "again", merged=False)
    counted = numbered(again, ["hash"], scratch, order)
    own = F.conv(F.substring(F.md5(F.concat(F.col("hash").cast("string"), F.lit("#"), F.col("repeat").cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")
    hashed = counted.withColumn("hash", F.when(F.col("repeat") == 0, F.col("hash")).otherwise(own))
    return rows.join(repeated, "hash", "left_anti").select(*rows.columns).unionAll(hashed.select(*rows.columns))


def budgets(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(rows, thresholds, repeated): rows holds (id, source, size, hash), narrow and written; the hashes that rows repeat, if any."""
    scratch = Scratch(docs.sparkSession, "mix")
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), row_hash(F.col(id_col), F.col(text_col)).alias("hash"),
    )
    rows = scratch.write(narrow, "rows", merged=False)
    repeated = scratch.write(rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated")
    if repeated.isEmpty():
        repeated = None
    else:
        rows = scratch.write(_apart(rows, repeated, scratch, ("source", "size", "id")), "rows", merged=False)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = source_targets(sizes, weights, most)
    return rows, scratch.write(thresholds(rows, targets, scratch), "thresholds"), repeated


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(id, size, source_size, target, copies, taken) for every row."""
    rows, limits, _ = budgets(docs, **options)
    limits = limits.withColumnRenamed("source", "_source")
    joined = rows.join(limits, rows["source"].eqNullSafe(limits["_source"]))
    copies = F.col("copies") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return joined.select("id", "size", "source_size", "target", copies.cast("int").alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix, each repeated as often as it is taken, with the columns of `docs`."""
    _, limits, repeated = budgets(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    limits = limits.select(F.struct("source").alias("of"), F.struct("copies", "below").alias("limit"))
    rows = docs.select(F.struct("*").alias("doc"), row_hash(F.col(id_col), F.col(text_col)).alias("hash"))
    if repeated is not None:
        rows = _apart(_sortable(rows, id_col, text_col, source_col), repeated, Scratch(docs.sparkSession, "mix-apart"), ("source", "size", "id", "mark"))
    joined = rows.withColumn("of", F.struct(F.col(f"doc.`{source_col}`").alias("source"))).join(limits, "of")
    copies = F.col("limit.copies") + F.when(F.col("hash") < F.col("limit.below"), 1).otherwise(0)
    return joined.select("doc", F.explode(F.array_repeat(F.lit(True), copies.cast("int")))).select("doc.*")


def _sortable(rows: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """`rows` (doc, hash) with the columns that repeats are numbered by."""
    return rows.select(
        "doc", "hash", F.col(f"doc.`{source_col}`").alias("source"), word_count(F.col(f"doc.`{text_col}`")).alias("size"),
        F.col(f"doc.`{id_col}`").cast("long").alias("id"), F.md5(F.to_json("doc")).alias("mark"),
    )
