"""The refreshed panel, the audit of late rows and the SQL table function."""

import os

import pytest
from pyspark.sql import functions as F

from blockpulse.fixtures import table
from blockpulse.operators import table_functions
from blockpulse.plans.panels import panel
from blockpulse.plans.sources_sinks import refresh_panel
from blockpulse.sources import snapshots
from blockpulse.streaming import jobs


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_untouched_years_keep_their_files(spark, sf, tmp_path):
    path, cut = str(tmp_path / "state"), F.lit("2000-07-01").cast("date")
    first = refresh_panel(spark, sf, path, cut)
    before = files(path)
    old = snapshots.read(spark, path, panel(spark, sf).schema)
    old_days = sorted(r.event_date for r in old.collect())
    assert first == list(range(1995, 2001)) and max(map(str, old_days)) < "2000-07-01"
    assert refresh_panel(spark, sf, path) == [2000, 2001]
    after = files(path)
    assert {k: v for k, v in after.items() if k in before} == before
    assert not any("rev=2" in k and any(f"year={y}" in k for y in range(1995, 2000)) for k in after)
    whole = snapshots.read(spark, path, panel(spark, sf).schema).drop("year")
    assert sorted(map(str, whole.collect())) == sorted(map(str, panel(spark, sf).collect()))
    # A reader that began before the refresh still has its state.
    assert sorted(r.event_date for r in old.collect()) == old_days
    assert sorted(r.event_date for r in snapshots.read(spark, path, panel(spark, sf).schema, revision=1).collect()) == old_days
    assert refresh_panel(spark, sf, path) == [] and files(path) == after
    snapshots.drop_old(spark, path)
    assert sorted(map(str, snapshots.read(spark, path, panel(spark, sf).schema).drop("year").collect())) == sorted(map(str, whole.collect()))
    assert not any("rev=1/year=2000" in k for k in files(path))


def state(spark, path):
    return sorted((str(r.day), r.n) for r in snapshots.read(spark, path, spark.createDataFrame([], "day date, n int").schema).select("day", "n").collect())


def refresh(spark, path, rows, fail=False):
    df = spark.createDataFrame([(d, n) for d, n in rows], "d string, n int").select(F.col("d").cast("date").alias("day"), "n")
    marks = df.groupBy(F.year("day").alias("year")).agg(F.count("*").alias("rows"), F.sum(F.pmod(F.xxhash64("day", "n"), F.lit(1000003))).alias("mark"))

    def build(years):
        wanted = df.where(F.year("day").isin(years))
        return wanted.withColumn("n", F.when(F.lit(fail), F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int")) if fail else wanted

    return snapshots.refresh(marks, build, "day", path)


def test_failed_refreshes_are_not_seen_and_years_can_go(spark, tmp_path):
    path, one = str(tmp_path / "s"), [("2001-01-05", 1), ("2002-03-01", 2)]
    assert state(spark, path) == []
    assert refresh(spark, path, one) == [2001, 2002] and state(spark, path) == one
    with pytest.raises(Exception, match="lost"):
        refresh(spark, path, [*one, ("2002-04-01", 3)], fail=True)
    assert state(spark, path) == one
    assert refresh(spark, path, [*one, ("2002-04-01", 3)]) == [2002] and state(spark, path) == [*one, ("2002-04-01", 3)]
    assert refresh(spark, path, one[:1]) == [] and state(spark, path) == one[:1]
    assert refresh(spark, path, []) == [] and state(spark, path) == []


def test_audit_equals_the_stream_and_survives_a_replay(spark, sf, tmp_path):
    events, folder = table(spark, sf, "events"), str(tmp_path / "in")
    audit, checkpoint = str(tmp_path / "audit"), str(tmp_path / "audit-checkpoint")
    counts, other = str(tmp_path / "counts"), str(tmp_path / "counts-checkpoint")
    session, dropped = jobs.state_session(spark, 2), 0

    def run():
        stream = jobs.file_stream(spark, folder, events.schema, files_per_batch=1_000_000)
        jobs.stream_audit(stream, "ts", "event_type", audit, checkpoint, "1 DAY")

    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.mode("append").parquet(folder)
        run()
        stream = jobs.file_stream(session, folder, events.schema, files_per_batch=1_000_000)
        dropped += sum(jobs.dropped_by_engine(jobs.stream_daily_counts(stream, "ts", "event_type", counts, other, "1 day")).values())
    found = sorted(jobs.audited(spark, audit).collect())
    streamed = {(r.event_date, r.feed): r.n for r in jobs.current_counts(spark, counts).collect()}
    assert all(streamed.get((r.event_date, r.feed), 0) == r.streamed and r.expected == r.streamed + r.late for r in found)
    assert sum(r.expected for r in found) == events.count() and (dropped > 0) == (sum(r.late for r in found) > 0) and dropped > 0
    # The last batch was not committed: it runs again and writes the same.
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert sorted(jobs.audited(spark, audit).collect()) == found


def test_table_function(spark):
    rows = [(float(k), float(k * k), 7.0, None if k % 3 else float(-k)) for k in range(20)]
    frame = spark.createDataFrame(rows, "a double, `it's b` double, c double, d double")
    table_functions.register_correlations(frame, frame.columns, "corr_of_test")
    found = {r.col_name: r.correlation for r in spark.sql("SELECT * FROM corr_of_test('a')").collect()}
    pandas = frame.toPandas().astype(float).corr()["a"]
    assert set(found) == set(frame.columns) and found["a"] == 1.0 and found["c"] is None
    assert found["it's b"] == pytest.approx(pandas["it's b"]) and found["d"] == pytest.approx(pandas["d"])
    assert spark.sql("SELECT * FROM corr_of_test('none')").collect() == []
    matrix = spark.sql(table_functions.correlation_matrix_sql(frame.columns, "corr_of_test"))
    assert matrix._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert {r.feature: r["it's b"] for r in matrix.collect()}["d"] == pytest.approx(spark.sql("SELECT * FROM corr_of_test('d')").where("col_name = \"it's b\"").first().correlation)
