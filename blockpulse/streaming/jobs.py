"""Incremental forms of the daily counts, the newest document per key and the routed sinks.

Every sink writes one folder per micro-batch and overwrites it when the batch is replayed, so a
restart after a lost driver or executor gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from blockpulse.operators.documents import newest_scrape, routed
from blockpulse.sources.files import finished_folders

def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for a stateful stream, with its own number of state partitions.

    The number is fixed when a checkpoint is first written; by default it is the session's number of
    shuffle partitions. A small state, such as one row per day and feed, needs only a few.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 4
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_available(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    """Process everything that is there in micro-batches, then stop."""
    job = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return job


def _batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def daily_counts(events: DataFrame, ts: str, feed: str, delay: str = "2 days") -> DataFrame:
    """Count per feed and day, updated as rows arrive; rows later than `delay` are dropped."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    counts = timed.groupBy(F.window("_ts", "1 day").alias("w"), F.col(feed).alias("feed")).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").cast("date").alias("event_date"), "feed", "n")


def stream_daily_counts(events: DataFrame, ts: str, feed: str, path: str, checkpoint: str, delay: str = "2 days"):
    """Write updated counts batch by batch; `current_counts` gives the state so far."""
    counts = daily_counts(events, ts, feed, delay)
    return run_available(counts, _batch_writer(path), checkpoint, "update")


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """Newest count per (day, feed): an update always replaces the one before it."""
    updates = spark.read.option("basePath", path).parquet(path)
    return updates.groupBy("event_date", "feed").agg(F.max_by("n", "batch_id").alias("n"))


COMPACT_EVERY = 10


def _segments(batches: int, every: int) -> list[str]:
    """Segments that hold the first `batches` batches: as few as there are, oldest and largest first."""
    if every < 2:
        raise ValueError("at least two segments are merged")
    level, out, start = 0, [], 0
    while every ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        while start + every**k <= batches:
            start += every**k
            out.append(f"level={k}/{start - 1}")
    return out


def stream_newest(
    documents: DataFrame, key: str, stamp: str, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep the newest row per key.

    A batch writes its own newest rows as a segment of level 0. Every `compact_every` segments of a
    level are merged into one of the next, so a row is written again once per level, of which there
    are as many as digits in the number of batches, and a reader faces few segments. Segment names
    depend on the batch id alone, which makes a replayed batch overwrite its earlier attempt.
    """
    _segments(0, compact_every)
    schema = documents.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        newest_scrape(batch, key, stamp).write.mode("overwrite").parquet(f"{path}/level=0/{batch_id}")
        level, done = 1, batch_id + 1
        while done % compact_every**level == 0:
            size = compact_every ** (level - 1)
            parts = [f"{path}/level={level - 1}/{batch_id - size * k}" for k in range(compact_every)]
            merged = newest_scrape(batch.sparkSession.read.schema(schema).parquet(*parts), key, stamp)
            merged.write.mode("overwrite").parquet(f"{path}/level={level}/{batch_id}")
            level += 1

    return run_available(documents, write, checkpoint, "append")


def current_newest(
    spark: SparkSession, schema: T.StructType, key: str, stamp: str, path: str, compact_every: int = COMPACT_EVERY
) -> DataFrame:
    """Newest row per key after the last finished batch, found from the folders alone.

    A segment of a higher level is used only once its write was finished.
    """
    done = [int(b) for b in finished_folders(spark, f"{path}/level=0")]
    if not done:
        return spark.createDataFrame([], schema)
    batches = max(done) + 1
    segments = _segments(batches, compact_every)
    level, newest = segments[-1].split("/")
    if newest not in finished_folders(spark, f"{path}/{level}"):
        # The newest merge was not finished: read what it is made of.
        segments = [*_segments(batches - 1, compact_every), f"level=0/{batches - 1}"]
    folders = [f"{path}/{s}" for s in segments]
    return newest_scrape(spark.read.schema(schema).parquet(*folders), key, stamp)


def stream_route(documents: DataFrame, in_city: Column, path: str, checkpoint: str):
    """Every document to `all` and to one of two branches, one partitioned folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        routed(batch, in_city).write.mode("overwrite").partitionBy("dest").parquet(target)

    return run_available(documents, write, checkpoint, "append")


def stream_audit(events: DataFrame, ts: str, feed: str, path: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Count what a stream with this watermark takes and what is too late, per batch, day and feed.

    Every batch is reduced once and written under its id: rows, rows that are late, and the newest time.
    A row is late if its day ended no later than `delay` before the newest time of the batches before, the
    rule by which the counts of `daily_counts` leave it out. That time is read from what the batch before
    wrote, so a replayed batch finds the same rows late and overwrites its earlier attempt.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, counted = batch.sparkSession, f"{path}/counts/batch_id={batch_id}"
        newest = spark.read.schema("newest timestamp").parquet(f"{path}/marks/batch_id={batch_id - 1}").first()[0] if batch_id else None
        seen = batch.select(F.col(ts).cast("timestamp").alias("at"), F.col(feed).alias("feed")).withColumn("event_date", F.to_date("at"))
        ended = F.col("event_date").cast("timestamp") + F.expr("INTERVAL 1 DAY")
        late = F.coalesce(ended <= F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        counts = seen.groupBy("event_date", "feed").agg(F.count("*").alias("rows"), F.count(F.when(late, 1)).alias("late"), F.max("at").alias("newest"))
        counts.write.mode("overwrite").parquet(counted)
        # One row: the newest time of all batches so far.
        own = spark.read.schema(_AUDIT).parquet(counted).agg(F.max("newest").alias("newest"))
        own.select(F.greatest("newest", F.lit(newest).cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    return run_available(events, write, checkpoint, "append")


_AUDIT = "event_date date, feed string, rows long, late long, newest timestamp"


def audited(spark: SparkSession, path: str) -> DataFrame:
    """(event_date, feed, expected, streamed, late) over all batches that `stream_audit` wrote."""
    batches = spark.read.schema(_AUDIT).parquet(f"{path}/counts")
    rows, late = F.sum("rows"), F.sum("late")
    return batches.groupBy("event_date", "feed").agg(rows.alias("expected"), (rows - late).alias("streamed"), late.alias("late"))


def dropped_by_engine(job: StreamingQuery) -> dict[int, int]:
    """Rows that the engine's own watermark left out, by batch id. It counts a batch's rows after they were reduced per key."""
    found: dict[int, int] = {}
    for progress in job.recentProgress:
        dropped = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        found[progress["batchId"]] = found.get(progress["batchId"], 0) + dropped
    return found


def late_rows(events: DataFrame, ts: str, feed: str, streamed: DataFrame) -> DataFrame:
    """Rows the stream left out per (day, feed): batch recount minus streamed count."""
    day = F.col(ts).cast("date").alias("event_date")
    whole = events.groupBy(day, F.col(feed).alias("feed")).agg(F.count("*").alias("expected"))
    both = whole.join(streamed, ["event_date", "feed"], "left")
    n = F.coalesce("n", F.lit(0))
    return both.select("event_date", "feed", "expected", n.alias("streamed"), (F.col("expected") - n).alias("late"))
