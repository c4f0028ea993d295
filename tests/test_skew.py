"""One key, day or value holds a third of all rows or more: results stay whole and plans pre-aggregate."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from blockpulse.functions.values import tract_bin
from blockpulse.operators import aggregates, joins
from blockpulse.operators import documents as doc
from blockpulse.operators import ranking
from blockpulse.operators import windows as win
from blockpulse.operators.panel import Feed, aligned_panel

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    return spark.range(N).select("id", key.cast("bigint").alias("k"), (F.col("id") * 7919 % N).alias("v")).cache()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_per_key(skewed):
    got = {r["k"]: r["id"] for r in win.newest_per_key(skewed, "k", [F.col("v")]).collect()}
    expected = skewed.toPandas().sort_values("v").groupby("k").tail(1).set_index("k")["id"].to_dict()
    assert got == expected


def test_newest_per_key_combines_before_the_shuffle(skewed):
    plan = plan_of(win.newest_per_key(skewed, "k", [F.col("v")]))
    assert "partial_max_by" in plan and "Window" not in plan


def test_panel_with_a_hot_day_has_one_shuffle(spark, skewed):
    day = F.date_add(F.lit(date(2020, 1, 1)), (F.col("k") % 50).cast("int"))
    rows = skewed.select(day.alias("d"), "v")
    feeds = [
        Feed("sales", rows, F.col("d"), "total", "mean", measure=F.col("v")),
        Feed("odd", rows, F.col("d"), "odd", where=F.col("v") % 2 == 1),
    ]
    panel = aligned_panel(feeds, lambda d: d, "day", "sales")
    assert plan_of(panel).count("Exchange hashpartitioning") == 1
    local = rows.toPandas()
    for r in panel.collect():
        mine = local[local["d"] == r["day"]]["v"]
        assert r["total"] == len(mine) and r["odd"] == int((mine % 2 == 1).sum())
        assert r["mean"] == pytest.approx(mine.mean())


@pytest.fixture
def small_thresholds(spark):
    """Settings under which this little data counts as too large to broadcast and as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def test_lookup_splits_a_hot_key(spark, skewed, small_thresholds):
    rows = skewed.repartition(6, "id")
    stations = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("block"))
    joined = joins.lookup(rows, stations, ["k"], ["block"])
    assert len(joined.collect()) == N
    assert "skew=true" in plan_of(joined)
    assert joined.where("block IS NULL").count() == skewed.where("k >= 500").count()


def test_geocoding_splits_a_hot_address(spark, skewed, small_thresholds):
    rows = skewed.repartition(6, "id").select("id", F.concat(F.col("k").cast("string"), F.lit(" Main  st")).alias("street"))
    known = spark.range(997).select(F.concat(F.lit(" "), F.col("id").cast("string"), F.lit(" MAIN ST")).alias("street"), F.col("id").alias("tract"))
    placed = joins.geocode_lookup(rows, known, ["street"], ["tract"])
    assert len(placed.collect()) == N
    assert "skew=true" in plan_of(placed)


def test_security_rows_of_a_hot_code(spark, skewed, small_thresholds):
    market = skewed.repartition(6, "id").select(F.col("k").alias("infocode"), F.lit(date(2020, 1, 1)).alias("marketdate"), "id")
    mapping = spark.range(997).select(F.col("id").alias("infocode"), F.lit("T").alias("ticker"))
    daily = joins.security_daily(market, mapping, date(2019, 1, 1), date(2021, 1, 1))
    assert len(daily.collect()) == N
    assert "skew=true" in plan_of(daily)


def test_codes_of_a_hot_value(spark, skewed):
    coded = ranking.label_encode(skewed.select("id", "k"), ["k"])
    order = {k: i for i, k in enumerate(sorted(r["k"] for r in skewed.select("k").distinct().collect()))}
    got = {r["id"]: r["k"] for r in coded.collect()}
    assert len(got) == N
    assert got == {r["id"]: order[r["k"]] for r in skewed.collect()}


def test_codes_over_many_range_partitions(spark):
    values = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        codes = ranking.sorted_codes(values, ["x"])
        assert codes.where(F.col("code") != F.col("num").cast("bigint")).count() == 0
        assert codes.count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_hot_histogram_and_top_groups(skewed):
    counts = {r["bin"]: r["n"] for r in aggregates.histogram(skewed, ["k"], 10).collect()}
    assert sum(counts.values()) == N and counts[1] >= N // 3
    top = aggregates.top_groups(skewed, "k", 1).first()
    assert (top["k"], top["n"]) == (0, skewed.where("k = 0").count())


def test_hot_tract_counts(skewed):
    rows = skewed.select((F.col("k") * 300).alias("tract"), F.lit("2020-01").alias("m"))
    got = {r["tract_grp"]: r["n"] for r in aggregates.tract_counts(rows, "tract", F.col("m"), "month").collect()}
    expected = rows.select(tract_bin(F.col("tract")).alias("g")).dropna().toPandas()["g"].value_counts().to_dict()
    assert got == expected


def test_every_document_is_routed_twice(skewed):
    routed = doc.routed(skewed, F.col("k") == 0)
    counts = {r["dest"]: r["count"] for r in routed.groupBy("dest").count().collect()}
    assert counts["all"] == N and counts["nyc"] + counts["not_nyc"] == N
