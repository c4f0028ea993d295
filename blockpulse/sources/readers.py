"""Readers for catalogues, positional sheets, archives, documents and tables."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from typing import BinaryIO
from urllib.parse import quote

import pandas as pd
from pyarrow import ArrowException, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.functions.calendar import any_date
from blockpulse.sources.listing_schema import DOCUMENT, ddl_schema


def read_catalogue(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str] | None = None, views: bool = False
) -> dict[str, DataFrame]:
    """{name: path} to {name: frame}; the reader follows the file extension, CSV or Parquet.

    A CSV without a given schema is read as text columns under its header: nothing is inferred,
    so no file is read twice.
    """
    frames = {}
    for name, path in paths.items():
        schema = (schemas or {}).get(name)
        if path.rstrip("/").endswith(".csv"):
            reader = spark.read.option("header", True)
            frames[name] = (reader.schema(schema) if schema else reader).csv(path)
        elif path.rstrip("/").endswith(".parquet"):
            frames[name] = spark.read.parquet(path)
        else:
            raise ValueError(f"no reader for {path}")
        if views:
            frames[name].createOrReplaceTempView(name)
    return frames


# Positional columns of a sales sheet.
SHEET_COLUMNS = [
    "BOROUGH", "NEIGHBORHOOD", "BUILDING_CLASS_CATEGORY", "TAX_CLASS_PRESENT", "BLOCK", "LOT", "EASE-MENT",
    "BUILDING_CLASS_PRESENT", "ADDRESS", "APARTMENT_NUMBER", "ZIP_CODE", "RESIDENTIAL_UNITS", "COMMERCIAL_UNITS",
    "TOTAL_UNITS", "LAND_SF", "GROSS_SF", "YEAR_BUILT", "TAX_CLASS_SALE", "BUILDING_CLASS_SALE", "SALE_PRICE",
    "SALE_DATE",
]
_SHEET_TYPES = {
    "BOROUGH": "int", "RESIDENTIAL_UNITS": "bigint", "COMMERCIAL_UNITS": "bigint", "TOTAL_UNITS": "bigint",
    "LAND_SF": "bigint", "GROSS_SF": "bigint", "YEAR_BUILT": "int", "SALE_PRICE": "bigint", "SALE_DATE": "date",
}


def read_positional(spark: SparkSession, paths: Sequence[str] | str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of header-less sheets with named positions.

    A file has no row order once it is split between tasks, so the lines above the data are told apart
    by their form: a data line has all 21 positions and something beyond the first, whatever else is
    blank. Every other line is in `rejects` (file, line). A file that cannot be read fails the read;
    nothing is skipped.
    """
    schema = ", ".join(f"`{c}` STRING" for c in [*SHEET_COLUMNS, "_odd"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_odd"}
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.from_csv("value", schema, options).alias("row")
    )
    filled = F.coalesce(*[F.col(f"row.`{c}`") for c in SHEET_COLUMNS[1:]]).isNotNull()
    is_data = F.col("row._odd").isNull() & filled
    rows = lines.where(is_data).select(
        *[
            any_date(F.col(f"row.`{c}`")).alias(c) if _SHEET_TYPES.get(c) == "date"
            else F.col(f"row.`{c}`").try_cast(_SHEET_TYPES.get(c, "string")).alias(c)
            for c in SHEET_COLUMNS
        ]
    )
    return rows, lines.where(~is_data).select("file", "line")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.load(path).select("path", "length")


def select_inputs(listing: DataFrame, suffix: str = ".csv.zip", containing: str = "JC", drop_last: int = 14) -> DataFrame:
    """Files by suffix and name part, without the last `drop_last` in name order."""
    wanted = listing.where(F.col("path").endswith(suffix) & F.col("path").contains(containing))
    tail = wanted.select("path").orderBy(F.desc("path")).limit(drop_last)
    return wanted.join(tail, "path", "left_anti").orderBy("path")


ROWS_PER_CHUNK = 50_000
#: Bytes of the largest archive of a folder that a task holds; a larger one is read in place.
IN_MEMORY = 256 << 20


def open_in_place(path: str) -> BinaryIO:
    """A file of a store as a seekable stream; what is not read is not held."""
    if not re.match(r"\w[\w+.-]*:", path) or path.startswith("file:"):
        return open(re.sub(r"^file:(//(?=/))?", "", path), "rb")
    scheme, rest = path.split(":", 1)
    store, inside = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return store.open_input_file(inside)


def read_zip_csv(archives: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """CSV members of zip archives: (path, member, error, columns as text).

    `archives` holds (path, content), as the binaryFile source gives them; one without a content
    column is read in place, member by member, wherever its path leads. Every member's own
    header is brought to `columns` by the rename map; a column it lacks is NULL. An archive or
    member that cannot be read becomes one row with the reason in `error`. Archives are spread
    over tasks; a task holds one archive (none, when read in place) and one chunk of rows at a time.
    """
    wanted, names = list(columns), dict(rename or {})
    layout = ["path", "member", "error", *wanted]

    def failure(path: str, member: str | None, problem: Exception) -> pd.DataFrame:
        row = [path, member, f"{type(problem).__name__}: {problem}", *[None] * len(wanted)]
        return pd.DataFrame([row], columns=layout, dtype=object)

    def member_rows(archive: zipfile.ZipFile, path: str, member: str) -> Iterator[pd.DataFrame]:
        as_text = {"dtype": object, "keep_default_na": False, "na_values": [""]}
        with archive.open(member) as raw:
            for chunk in pd.read_csv(raw, chunksize=ROWS_PER_CHUNK, **as_text):
                named = chunk.rename(columns=names).assign(path=path, member=member, error=None)
                rows = named.reindex(columns=layout).astype(object)
                yield rows.where(rows.notna(), None)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        problems = (zipfile.BadZipFile, UnicodeDecodeError, ValueError, OSError, EOFError, ArrowException)
        for batch in batches:
            contents = batch["content"] if held else [None] * len(batch)
            for path, content in zip(batch["path"], contents):
                try:
                    file = io.BytesIO(content) if held else open_in_place(path)
                except problems as e:
                    yield failure(path, None, e)
                    continue
                with file:
                    try:
                        archive = zipfile.ZipFile(file)
                    except problems as e:
                        yield failure(path, None, e)
                        continue
                    with archive:
                        for member in (m for m in archive.namelist() if m.endswith(".csv")):
                            try:
                                yield from member_rows(archive, path, member)
                            except problems as e:
                                yield failure(path, member, e)

    held = "content" in archives.columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in layout])
    return archives.select("path", *["content"] * held).mapInPandas(expand, schema)


def read_zip_folder(
    spark: SparkSession, path: str, columns: Sequence[str], rename: Mapping[str, str] | None = None, largest: int | None = None
) -> DataFrame:
    """`read_zip_csv` over the archives below a folder, found by listing, whatever their size.

    Archives above IN_MEMORY are read in place by a task each. Only a caller that gives `largest` has the
    archives above it left unopened: each is one row with the reason in `error`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    wanted = files if largest is None else files.where(F.col("length") <= largest)
    held = read_zip_csv(wanted.where(F.col("length") <= IN_MEMORY), columns, rename)
    rows = held.unionByName(read_zip_csv(wanted.where(F.col("length") > IN_MEMORY).select("path"), columns, rename))
    if largest is None:
        return rows
    reason = F.concat(F.lit("TooLarge: "), F.col("length").cast("string"), F.lit(" bytes"))
    nothing = [F.lit(None).cast("string").alias(c) for c in columns]
    above = files.where(F.col("length") > largest).select("path", F.lit(None).cast("string").alias("member"), reason.alias("error"), *nothing)
    return rows.unionByName(above)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested listing documents with an explicit schema."""
    return spark.read.schema(ddl_schema(DOCUMENT)).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def schema_audit(frames: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """(table_name, column_name, data_type) of the given frames, from their schemas alone."""
    spark = next(iter(frames.values())).sparkSession
    rows = [
        (table, name, kind)
        for table, df in frames.items()
        for name, kind in df.dtypes
        if columns is None or name in columns
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def cast_dates(frames: Mapping[str, DataFrame], columns: Sequence[str]) -> dict[str, DataFrame]:
    """Every listed column found in a frame becomes a date; unreadable text becomes NULL."""
    out = {}
    for name, df in frames.items():
        casts = {}
        for c, kind in df.dtypes:
            if c in columns and kind != "date":
                casts[c] = any_date(F.col(f"`{c}`")) if kind == "string" else F.col(f"`{c}`").cast("date")
        out[name] = df.withColumns(casts)
    return out
