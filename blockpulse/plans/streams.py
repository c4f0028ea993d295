"""Streaming jobs run over the test tables as file streams until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockpulse.fixtures import table
from blockpulse.listing_fixture import documents
from blockpulse.plans.registry import query
from blockpulse.session import shared_path
from blockpulse.streaming import jobs

#: Events arrive in this many runs, those of a run told by the event's number.
ARRIVALS, DELAY_DAYS = 3, 1


@query(
    "stream_daily_counts",
    "SELECT CAST(ts AS DATE) AS event_date, event_type AS feed, COUNT(*) AS n FROM events GROUP BY 1, 2",
)
def stream_daily_counts(spark, sf):
    """Daily event counts kept up to date by a stream that takes one file a batch.

    Events arrive in the order of their time, in several loads. Files of one load may be taken in any
    order, so the watermark waits for as long as a load lasts, and nothing is late.
    """
    folder, path, checkpoint = shared_path(spark, "arrivals"), shared_path(spark, "counts"), shared_path(spark, "counts-checkpoint")
    events = table(spark, sf, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is not None:
        share = (last - first) / ARRIVALS
        for run in range(ARRIVALS):
            until = F.col("ts") < F.lit(first + share * (run + 1)) if run + 1 < ARRIVALS else F.lit(True)
            events.where((F.col("ts") >= F.lit(first + share * run)) & until).write.mode("append").parquet(folder)
        stream = jobs.file_stream(jobs.state_session(spark), folder, events.schema, files_per_batch=1)
        jobs.stream_daily_counts(stream, "ts", "event_type", path, checkpoint, delay=f"{share.days + 2} days")
        return jobs.current_counts(spark, path)
    return spark.createDataFrame([], "event_date date, feed string, n long")


def scrape_stream(spark, sf):
    """The scraped documents as a stream of several files."""
    folder = shared_path(spark, "scrapes")
    rows = documents(spark, sf).select(
        "root.zpid", F.col("root.extractTimestamp").alias("extract_ts"), "root.property.overview.price",
        "root.property.overview.state",
    )
    rows.write.parquet(folder)
    return jobs.file_stream(spark, folder, rows.schema, files_per_batch=2)


@query(
    "stream_latest_per_key",
    """SELECT c AS zpid, strftime(scraped_at, '%d/%m/%Y %H:%M:%S') AS extract_ts, price, state
    FROM scrapes QUALIFY ROW_NUMBER() OVER (PARTITION BY c ORDER BY scraped_at DESC) = 1""",
)
def stream_latest_per_key(spark, sf):
    """Newest document per listing, merged micro-batch by micro-batch."""
    path, checkpoint = shared_path(spark, "newest"), shared_path(spark, "newest-checkpoint")
    scrapes = scrape_stream(spark, sf)
    jobs.stream_newest(scrapes, "zpid", "extract_ts", path, checkpoint, compact_every=2)
    return jobs.current_newest(spark, scrapes.schema, "zpid", "extract_ts", path, compact_every=2)


@query(
    "stream_route",
    """SELECT 'all' AS dest, c AS zpid, price, state FROM scrapes
    UNION ALL SELECT CASE WHEN state = 'NY' THEN 'nyc' ELSE 'not_nyc' END, c, price, state FROM scrapes""",
)
def stream_route(spark, sf):
    path, checkpoint = shared_path(spark, "route"), shared_path(spark, "route-checkpoint")
    jobs.stream_route(scrape_stream(spark, sf), F.col("state") == "NY", path, checkpoint)
    return spark.read.option("basePath", path).parquet(path).select("dest", "zpid", "price", "state")


# A run is one micro-batch and the empty one that moves the watermark: a run drops days that ended
# `DELAY_DAYS` before the newest event of the runs before it.
@query(
    "stream_late_audit",
    f"""
    WITH e AS (SELECT event_type AS feed, ts, CAST(ts AS DATE) AS event_date, event_id % {ARRIVALS} AS run FROM events),
    m AS (SELECT run, MAX(MAX(ts)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY_DAYS} DAY AS mark
          FROM e GROUP BY run)
    SELECT event_date, feed, COUNT(*) AS expected, COUNT(*) FILTER (mark IS NULL OR event_date + INTERVAL 1 DAY > mark) AS streamed,
           COUNT(*) FILTER (event_date + INTERVAL 1 DAY <= mark) AS late
    FROM e JOIN m USING (run) GROUP BY 1, 2
    """,
)
def stream_late_audit(spark, sf):
    """Events reach the stream out of order under a short watermark; each batch counts what is too late as it passes.

    The stream is stopped and started again for every arrival.
    """
    folder, path, checkpoint = shared_path(spark, "disordered"), shared_path(spark, "audit"), shared_path(spark, "audit-checkpoint")
    events = table(spark, sf, "events")
    for run in range(ARRIVALS):
        events.where(F.col("event_id") % ARRIVALS == run).write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, events.schema, files_per_batch=1_000_000)
        jobs.stream_audit(stream, "ts", "event_type", path, checkpoint, f"{DELAY_DAYS} DAY")
    return jobs.audited(spark, path)
