"""Listing payloads and documents made row by row from the orders table.

Every array has a handful of elements computed from the row itself, so the adapter is a
narrow projection without any grouping.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from blockpulse.fixtures import table
from blockpulse.operators.documents import listing_document
from blockpulse.oracle import define
from blockpulse.sources import listing_schema as ls


def _items(count: str, struct: str, most: int = 4) -> str:
    numbers = ", ".join(str(i) for i in range(1, most + 1))
    return f"transform(filter(array({numbers}), i -> i <= {count}), i -> {struct})"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _entity(keys: list[str], **known: str) -> str:
    """Struct of all keys of an entity; keys without a value are NULL."""
    return _struct(**{k: f"CAST({known.get(k, 'NULL')} AS {ls.key_type(k)})" for k in keys})


_HOME = _struct(
    zpid="n * 10 + i", price="CAST(100000 * i AS BIGINT)",
    address=_struct(streetAddress="i || ' Side St'", city="'Albany'", state="'NY'", zipcode="'12201'"),
    miniCardPhotos="CASE WHEN (n + i) % 2 = 0 THEN array(named_struct('url', 'u' || n || '-' || i)) ELSE array() END",
    livingAreaUnits="'sqft'", livingAreaUnitsShort="'sf'", listingMetadata="'m'", formattedChip="'c'",
    attributionInfo="'a'", providerListingID="'p'",
)

# Columns of a payload, in terms of n (orderkey), c (custkey), amount and day.
_VALUES: dict[str, str] = {
    "zpid": "c",
    "streetAddress": "CAST(c % 300 AS STRING) || ' Main St'",
    "city": "CASE WHEN c % 2 = 0 THEN 'New York' ELSE 'Albany' END",
    "state": "CASE WHEN c % 3 = 0 THEN 'NJ' ELSE 'NY' END",
    "zipcode": "CAST(10000 + c % 250 AS STRING)",
    "longitude": "-74.0 + (c % 100) / 1000",
    "latitude": "40.0 + (c % 90) / 1000",
    "price": "CAST(FLOOR(amount) AS BIGINT)",
    "zestimate": "CASE WHEN n % 23 = 0 THEN NULL ELSE CAST(FLOOR(amount * (90 + n % 21) / 100) AS BIGINT) END",
    "propertyTaxRate": "(n % 5) / 4",
    "taxHistory": _items(
        "n % 4",
        _struct(time="'t' || i", value="CAST(1000 * i AS DOUBLE)",
                valueIncreaseRate="CASE WHEN (n + i) % 4 = 0 THEN NULL ELSE (n + i * 7) % 50 / 1000 END"),
    ),
    "priceHistory": "CASE WHEN n % 17 = 0 THEN NULL ELSE "
    + _items(
        "n % 5",
        _struct(date="'d' || i", event="CASE WHEN i % 2 = 0 THEN 'Sold' ELSE 'Listed' END",
                priceChangeRate="CASE WHEN (n + i) % 3 = 0 THEN NULL ELSE (n * i) % 11 / 100 END",
                buyerAgent="'b'", sellerAgent="'s'", showCountyLink="true", attributeSource="'x'"),
    )
    + " END",
    "sellingSoon": "CASE n % 6 WHEN 0 THEN NULL WHEN 1 THEN array() ELSE "
    "array(named_struct('percentile', n % 100 / 100, 'modelId', 'm1')) END",
    "schools": "CASE WHEN n % 13 = 0 THEN NULL ELSE "
    + _items(
        "n % 4",
        _struct(name="'PS ' || i", type="CASE WHEN (n + i) % 4 = 0 THEN 'Private' ELSE 'Public' END",
                gradeRange="'K-5'", rating="CASE WHEN (n + i) % 5 = 0 THEN NULL ELSE CAST(1 + (n * i) % 10 AS INT) END",
                distance="(n + i) % 30 / 10"),
    )
    + " END",
    "nearbyCities": _items("n % 3", _struct(name="'City ' || (c + i) % 50")),
    "nearbyNeighborhoods": _items("n % 2", _struct(name="'Hood ' || (c + i) % 70")),
    "nearbyZipcodes": "CASE WHEN n % 9 = 0 THEN NULL ELSE " + _items("n % 4", _struct(name="CAST(10000 + (c + i) % 250 AS STRING)")) + " END",
    "hiResLink": "'hi' || n",
    "streetViewMetadataUrlMediaWallLatLong": "'wall/' || c % 100",
    "streetViewMetadataUrlMediaWallAddress": "CASE WHEN n % 2 = 0 THEN 'wall-address/' || c END",
    "streetViewTileImageUrlMediumLatLong": "'tile/' || n % 10",
    "streetViewTileImageUrlMediumAddress": "'tile-address/' || n",
    "streetViewServiceUrl": "'service/' || n % 7",
    "daysListed": "n % 500",
    "favoriteCount": "n % 37",
    "pageViewCount": "n % 211",
    "coreLogicId": "'cl' || n",
    "postingUrl": "'listing/' || n",
    "resoFacts": _entity(
        ls.FEATURE_KEYS,
        hoaFee="CASE n % 4 WHEN 0 THEN 'HOA Fee: $' || format_number(n, 0) || ' monthly' WHEN 1 THEN '$' || n || '.5' "
        "WHEN 2 THEN 'nan' END",
        bedrooms="CAST(1 + FLOOR(amount / 120000) AS BIGINT)",
        bathrooms="1 + n % 2 + FLOOR(amount / 200000)",
        hasGarage="n DIV 16 % 2 = 0",
        hasHeating="n % 3 <> 0",
        homeType="CASE c % 4 WHEN 0 THEN 'CONDO' WHEN 1 THEN 'HOUSE' WHEN 2 THEN 'TOWNHOUSE' ELSE 'COOP' END",
        parkingCapacity="n DIV 4 % 4",
        yearBuilt="1900 + c % 120",
    ),
    "attributionInfo": _entity(
        ls.AGENT_KEYS,
        agentName="CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Solo' || c ELSE 'Ann ' || c || ' Lee' END",
        agentEmail="'a' || c || '@mail.test'",
        brokerName="'Broker ' || c % 97",
    ),
    "photos": _items(
        "n % 3",
        _struct(mixedSources=_struct(jpeg="array(named_struct('url', 's' || n || '-' || i, 'width', 576), "
                                          "named_struct('url', 'p' || n || '-' || i, 'width', 1536))")),
    ),
    "staticMap": _struct(sources="array(named_struct('url', 'small' || n, 'width', 384), "
                                 "named_struct('url', 'map' || n, 'width', 768))"),
    "comps": _items("n % 3", _HOME),
    "nearbyHomes": _items("n % 2", _HOME),
}


def _field(name: str):
    """One payload field; structs are built key by key so that unused ones can be pruned."""
    kind = ls.PAYLOAD_TYPES[name]
    if name not in _VALUES:
        return F.lit(None).cast(kind).alias(name)
    value = F.expr(_VALUES[name])
    return (value if kind.startswith("struct") else value.cast(kind)).alias(name)


# A geocoder's answer for the address of a scrape; every eighth address is not found.
_BLOCK = _struct(GEOID="'36' || LPAD(CAST(c AS STRING), 6, '0')", BLOCK="CAST(c % 9 AS STRING)",
                 TRACT="CAST(c * 911 % 310000 AS STRING)", BLKGRP="CAST(c % 4 AS STRING)")
_ANSWER = "CASE WHEN n % 8 = 0 THEN array() ELSE array(" + _struct(
    geographies=f"named_struct('2020 Census Blocks', array({_BLOCK}))",
    addressComponents="map('zip', CAST(10000 + c % 250 AS STRING), 'streetName', 'Main')",
    matchedAddress="CAST(c % 300 AS STRING) || ' MAIN ST'",
) + ") END"


def census_answers() -> Column:
    return F.expr(_ANSWER).cast(ls.CENSUS_ANSWER)


#: Where the payloads of a test folder were stored ahead, by application and folder, and their schema.
_STORED: dict[tuple[str, str], tuple[str, StructType]] = {}


@contextmanager
def stored_payloads(spark: SparkSession, sf: str, path: str) -> Iterator[None]:
    """Write the payloads once and read them from there meanwhile, so that what is timed does not make its own input."""
    whole, own = payloads(spark, sf, census=True), (spark.sparkContext.applicationId, sf)
    whole.write.parquet(path)
    _STORED[own] = path, whole.schema
    try:
        yield
    finally:
        del _STORED[own]


def payloads(spark: SparkSession, sf: str, keys: Sequence[str] | None = None, census: bool = False) -> DataFrame:
    """(scrape_id, scraped_at, p [, census]): one payload struct per order, with all or some of its keys."""
    if (spark.sparkContext.applicationId, sf) in _STORED:
        path, schema = _STORED[spark.sparkContext.applicationId, sf]
        found = spark.read.schema(schema).parquet(path)
        some = F.col("p") if keys is None else F.struct(*[F.col(f"p.{k}").alias(k) for k in ls.PAYLOAD_TYPES if k in keys]).alias("p")
        return found.select("scrape_id", "scraped_at", some, *(["census"] if census else []))
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS n", "o_custkey AS c", "o_totalprice AS amount",
        "timestamp_seconds(unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey % 86400) AS scraped_at",
    )
    fields = F.struct(*[_field(k) for k in ls.PAYLOAD_TYPES if keys is None or k in keys])
    answer = [census_answers().alias("census")] if census else []
    return rows.select(F.col("n").alias("scrape_id"), "scraped_at", fields.alias("p"), *answer)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Scraped documents: one `root` struct per scrape."""
    return listing_document(payloads(spark, sf), "p", "scraped_at")


define(
    "scrapes",
    """SELECT o_orderkey AS n, o_custkey AS c, o_totalprice AS amount,
    o_orderdate + to_seconds(o_orderkey % 86400) AS scraped_at, CAST(FLOOR(o_totalprice) AS BIGINT) AS price,
    CASE WHEN o_custkey % 3 = 0 THEN 'NJ' ELSE 'NY' END AS state FROM orders""",
)
define(
    "price_items",
    """SELECT n, i, CASE WHEN (n + i) % 3 = 0 THEN NULL ELSE (n * i) % 11 / 100 END AS rate
    FROM (SELECT n, unnest(range(1, 1 + n % 5)) AS i FROM scrapes WHERE n % 17 <> 0)""",
)
define(
    "tax_items",
    """SELECT n, i, CASE WHEN (n + i) % 4 = 0 THEN NULL ELSE (n + i * 7) % 50 / 1000 END AS rate
    FROM (SELECT n, unnest(range(1, 1 + n % 4)) AS i FROM scrapes)""",
)
define(
    "school_items",
    """SELECT n, i, CASE WHEN (n + i) % 5 = 0 THEN NULL ELSE 1 + (n * i) % 10 END AS rating, (n + i) % 30 / 10 AS distance,
    (n + i) % 4 = 0 AS private FROM (SELECT n, unnest(range(1, 1 + n % 4)) AS i FROM scrapes WHERE n % 13 <> 0)""",
)
