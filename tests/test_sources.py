"""Readers and writers on small files."""

import io
import subprocess
import sys
import zipfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from blockpulse.listing_fixture import documents
from blockpulse.session import scratch_run, shared_path
from blockpulse.sources import readers, rides, writers


def test_listing_and_selection_of_real_files(spark):
    folder = Path(shared_path(spark, "files"))
    folder.mkdir(parents=True)
    for i in range(18):
        (folder / f"JC-{202000 + i}.csv.zip").write_bytes(b"x" * (i + 1))
    (folder / "other-1.csv.zip").write_bytes(b"x")
    (folder / "JC-readme.txt").write_bytes(b"x")
    listing = readers.list_files(spark, str(folder))
    assert listing.count() == 20
    chosen = [Path(r["path"]).name for r in readers.select_inputs(listing).collect()]
    assert chosen == [f"JC-{202000 + i}.csv.zip" for i in range(4)]


def _zip(members: dict[str, str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def test_zipped_rides_of_three_generations(spark):
    folder = Path(shared_path(spark, "zips"))
    folder.mkdir(parents=True)
    for era, headers in enumerate(rides.ERAS):
        names = list(headers)
        values = [f"{headers[n]}-{era}" for n in names]
        quoted = ",".join(f'"{v}, with\na break"' if v.startswith("user_type") else v for v in values)
        (folder / f"JC-{era}.csv.zip").write_bytes(_zip({f"{era}.csv": ",".join(names) + "\n" + quoted + "\n", "notes.txt": "no"}))
    (folder / "JC-bad.csv.zip").write_bytes(b"broken")
    (folder / "JC-empty.csv.zip").write_bytes(_zip({"empty.csv": ""}))
    archives = spark.read.format("binaryFile").load(str(folder))
    rows = readers.read_zip_csv(archives, rides.RIDE_COLUMNS, rides.HEADERS).cache()
    good = {r["member"]: r for r in rows.where("error IS NULL").collect()}
    assert set(good) == {"0.csv", "1.csv", "2.csv"}
    for era in range(3):
        for c in rides.RIDE_COLUMNS:
            expected = f"{c}-{era}" + (", with\na break" if c == "user_type" else "")
            assert good[f"{era}.csv"][c] == expected
    bad = {Path(r["path"]).name: r["error"] for r in rows.where("error IS NOT NULL").collect()}
    assert set(bad) == {"JC-bad.csv.zip", "JC-empty.csv.zip"}


def test_archives_above_the_limit_are_rejected(spark):
    folder = Path(shared_path(spark, "zips"))
    (folder / "deep").mkdir(parents=True)
    (folder / "deep" / "a.zip").write_bytes(_zip({"a.csv": "n\n1\n2\n"}))
    (folder / "b.zip").write_bytes(_zip({"b.csv": "n\n" + "\n".join(map(str, range(5000)))}))
    rows = readers.read_zip_folder(spark, str(folder), ["n"], largest=1000).collect()
    assert sorted(r["n"] for r in rows if r["error"] is None) == ["1", "2"]
    assert [Path(r["path"]).name for r in rows if r["error"]] == ["b.zip"] and rows[-1]["error"].startswith("TooLarge")


def test_large_archives_are_read_in_place(spark, monkeypatch):
    folder = Path(shared_path(spark, "zips"))
    (folder / "a b").mkdir(parents=True)
    numbers = range(readers.ROWS_PER_CHUNK + 5)
    (folder / "a b" / "large%20.zip").write_bytes(_zip({"x.csv": "n\n" + "\n".join(map(str, numbers)), "y.csv": "m\n7\n", "empty.csv": ""}))
    (folder / "small.zip").write_bytes(_zip({"a.csv": "n\n-1\n-2\n"}))
    (folder / "bad.zip").write_bytes(b"broken" * 1000)
    monkeypatch.setattr(readers, "IN_MEMORY", 1000)
    rows = readers.read_zip_folder(spark, str(folder), ["n"], {"m": "n"}).collect()
    assert sorted(int(r["n"]) for r in rows if r["error"] is None) == sorted([-2, -1, 7, *numbers])
    assert {(Path(r["path"]).name, r["member"]) for r in rows if r["error"]} == {("large%20.zip", "empty.csv"), ("bad.zip", None)}


@pytest.mark.parametrize("start", ["", "file:", "file://"])
def test_files_open_in_place(tmp_path, start):
    (tmp_path / "a b#%20.zip").write_bytes(b"abc")
    with readers.open_in_place(f"{start}{tmp_path}/a b#%20.zip") as file:
        assert file.seekable() and file.read() == b"abc"


def test_ride_folder_with_mixed_headers(spark):
    folder = Path(shared_path(spark, "rides"))
    (folder / "more").mkdir(parents=True)
    for era, headers in enumerate(rides.ERAS):
        names = [*reversed(list(headers)), "extra"] if era == 1 else list(headers)
        values = ",".join(f"{headers.get(n, n)}-{era}" for n in names)
        (folder / ("more" if era else "") / f"{era}.csv").write_text(",".join(names) + f"\n{values}\n{values}\n")
    (folder / "odd.csv").write_text("started_at,ended_at\n1,2\n")
    (folder / "empty.csv").write_text("")
    found, rejects = rides.read_ride_folder(spark, str(folder))
    assert found.columns == rides.RIDE_COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == sorted(tuple(f"{c}-{era}" for c in rides.RIDE_COLUMNS) for era in range(3) for _ in range(2))
    assert {Path(r["path"]).name for r in rejects.collect()} == {"odd.csv", "empty.csv"}


def test_chunks_of_a_large_member(spark):
    text = "n\n" + "\n".join(str(i) for i in range(readers.ROWS_PER_CHUNK + 5)) + "\n"
    archives = spark.createDataFrame([("a.zip", bytearray(_zip({"a.csv": text})))], "path string, content binary")
    rows = readers.read_zip_csv(archives, ["n"])
    assert rows.agg(F.countDistinct(F.col("n").cast("int"))).first()[0] == readers.ROWS_PER_CHUNK + 5


def test_positional_sheet(spark):
    folder = Path(shared_path(spark, "sheets"))
    folder.mkdir(parents=True)
    cells = ["1", "N", "01 ONE", *[""] * 16, "250000", "2020-03-01"]
    short = ["2", "N"]
    title = "Rolling sales" + "," * 20
    undated, nowhere = [*cells[:-1], ""], ["", *cells[1:]]
    (folder / "a.csv").write_text("\n".join([title] * 10 + [",".join(c) for c in (cells, short, undated, nowhere)]))
    rows, rejects = readers.read_positional(spark, str(folder))
    found = {(r["BOROUGH"], r["SALE_PRICE"], r["SALE_DATE"]) for r in rows.collect()}
    assert found == {(1, 250000, date(2020, 3, 1)), (1, 250000, None), (None, 250000, date(2020, 3, 1))} and rows.count() == 3
    left = rejects.collect()
    assert sorted(r["line"] for r in left) == sorted([title] * 10 + [",".join(short)]) and all(r["file"].endswith("a.csv") for r in left)


def test_catalogue_follows_the_extension(spark):
    base = shared_path(spark, "catalogue")
    df = spark.range(3).withColumn("d", F.lit("1/2/2020"))
    writers.write_csv(df, f"{base}/a.csv")
    writers.write_replace({"b": df}, base)
    frames = readers.read_catalogue(spark, {"a": f"{base}/a.csv", "b": f"{base}/b.parquet"}, {"a": "id bigint, d string"}, views=True)
    assert spark.table("a").count() == spark.table("b").count() == 3
    dated = readers.cast_dates(frames, ["d"])
    assert all(dict(x.dtypes)["d"] == "date" and x.first()["d"] == date(2020, 1, 2) for x in dated.values())
    with pytest.raises(ValueError):
        readers.read_catalogue(spark, {"c": "c.xlsx"})


def test_stored_panel_reads_only_the_years_asked_for(spark):
    path = shared_path(spark, "panel")
    days = spark.sql("SELECT explode(sequence(DATE '2019-01-01', DATE '2021-12-31')) AS day")
    writers.store_panel(days, path, "day")
    plan = spark.read.parquet(path).where("year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert spark.read.parquet(path).where("year = 2020").count() == 366


def test_shared_folder_comes_from_the_session(tmp_path):
    """A session that names a shared folder gets its scratch files and checkpoints there."""
    code = f"""
from blockpulse.session import shared_path, ensure_checkpoint_dir
from blockpulse.operators.ranking import label_encode
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
assert shared_path(spark, "x").startswith("{tmp_path}")
label_encode(spark.range(5), ["id"]).collect()
assert "{tmp_path}" in spark.sparkContext.getCheckpointDir()
"""
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], check=True, timeout=180)
    assert any(p.name.startswith("codes-") for p in tmp_path.iterdir())


def test_stored_documents_are_compressed_files_of_bounded_rows(spark, sf, monkeypatch):
    from blockpulse.plans import documents as plans

    monkeypatch.setattr(plans, "ROWS_PER_FILE", 400)
    with scratch_run(spark):
        held = plans.stored_documents(spark, sf)
        assert sorted(map(str, held.collect())) == sorted(map(str, documents(spark, sf).collect()))
        per_file = held.groupBy(F.input_file_name().alias("file")).count().collect()
    assert all(r.file.endswith(".json.gz") and r["count"] <= 400 for r in per_file) and len(per_file) > 1
