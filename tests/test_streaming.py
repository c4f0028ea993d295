"""Streams over several files give the batch result, also when a batch is replayed."""

import pytest
from pyspark.sql import functions as F

from blockpulse.operators.documents import newest_scrape
from blockpulse.plans.registry import QUERIES, load_all
from blockpulse.session import shared_path
from blockpulse.sources.files import delete
from blockpulse.streaming import jobs

load_all()


@pytest.fixture(scope="module")
def scrapes(spark):
    moment = F.timestamp_seconds(F.lit(1_580_000_000) + (F.col("id") * 7919) % 4_000_000)
    return spark.range(3000).select(
        (F.col("id") % 400).alias("zpid"),
        F.date_format(moment, "dd/MM/yyyy HH:mm:ss").alias("stamp"),
        F.col("id").alias("price"),
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("every", [2, 3, 100])
def test_newest_equals_batch_for_any_compaction(spark, scrapes, every):
    folder, path = shared_path(spark, "in"), shared_path(spark, "out")
    scrapes.repartition(7).write.parquet(folder)
    stream = jobs.file_stream(spark, folder, scrapes.schema, files_per_batch=1)
    jobs.stream_newest(stream, "zpid", "stamp", path, shared_path(spark, "cp"), compact_every=every)
    got = jobs.current_newest(spark, scrapes.schema, "zpid", "stamp", path, compact_every=every)
    assert rows_of(got) == rows_of(newest_scrape(scrapes, "zpid", "stamp"))


def test_segments_cover_every_batch_once():
    for every in (2, 3, 10):
        for batches in range(60):
            covered = []
            for segment in jobs._segments(batches, every):
                level, last = segment.removeprefix("level=").split("/")
                covered += range(int(last) - every ** int(level) + 1, int(last) + 1)
            assert covered == list(range(batches))
    with pytest.raises(ValueError):
        jobs._segments(4, 1)


def test_newest_survives_a_restart_without_input(spark, scrapes):
    folder, path, checkpoint = (shared_path(spark, n) for n in ("in", "out", "cp"))
    assert jobs.current_newest(spark, scrapes.schema, "zpid", "stamp", path).collect() == []
    scrapes.coalesce(2).write.parquet(folder)
    for _ in range(2):
        stream = jobs.file_stream(spark, folder, scrapes.schema, files_per_batch=1)
        jobs.stream_newest(stream, "zpid", "stamp", path, checkpoint, compact_every=2)
        assert rows_of(jobs.current_newest(spark, scrapes.schema, "zpid", "stamp", path, 2)) == rows_of(newest_scrape(scrapes, "zpid", "stamp"))


def test_an_unfinished_merge_is_not_read(spark, scrapes):
    folder, path = shared_path(spark, "in"), shared_path(spark, "out")
    scrapes.repartition(4).write.parquet(folder)
    stream = jobs.file_stream(spark, folder, scrapes.schema, files_per_batch=1)
    jobs.stream_newest(stream, "zpid", "stamp", path, shared_path(spark, "cp"), compact_every=2)
    delete(spark, f"{path}/level=2/3")
    assert rows_of(jobs.current_newest(spark, scrapes.schema, "zpid", "stamp", path, 2)) == rows_of(newest_scrape(scrapes, "zpid", "stamp"))


def test_counts_survive_a_restart(spark):
    folder, path, checkpoint = (shared_path(spark, n) for n in ("in", "out", "cp"))
    moment = F.timestamp_seconds(F.lit(1_580_000_000) + F.col("id") * 600)
    events = spark.range(2000).select(moment.alias("ts"), (F.col("id") % 3).cast("string").alias("kind"))
    events.where("kind <> '2'").repartition(3).write.parquet(folder)
    stream = jobs.file_stream(spark, folder, events.schema, files_per_batch=1)
    jobs.stream_daily_counts(stream, "ts", "kind", path, checkpoint, delay="400 days")
    events.where("kind = '2'").repartition(2).write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, events.schema, files_per_batch=1)
    jobs.stream_daily_counts(stream, "ts", "kind", path, checkpoint, delay="400 days")
    expected = events.groupBy(F.col("ts").cast("date").alias("event_date"), F.col("kind").alias("feed")).agg(F.count("*").alias("n"))
    assert rows_of(jobs.current_counts(spark, path)) == rows_of(expected.select("event_date", "feed", "n"))


def test_a_replayed_batch_replaces_itself(spark, scrapes):
    path = shared_path(spark, "replay")
    write = jobs._batch_writer(path)
    write(scrapes, 0)
    write(scrapes, 0)
    assert spark.read.parquet(path).count() == scrapes.count()


def test_late_rows_are_counted(spark, sf):
    audit = QUERIES["stream_late_audit"](spark, sf)
    totals = audit.agg(F.sum("expected"), F.sum("streamed"), F.sum("late"), F.min("late")).first()
    assert totals[0] == totals[1] + totals[2]
    assert totals[3] >= 0 and totals[2] > 0
