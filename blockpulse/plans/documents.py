"""Listing documents, pages and sales leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.fixtures import feed, table
from blockpulse.functions import nested
from blockpulse.functions import values as val
from blockpulse.listing_fixture import documents, payloads
from blockpulse.operators import aggregates, filters
from blockpulse.operators import documents as doc
from blockpulse.operators import windows as win
from blockpulse.oracle import define
from blockpulse.plans.panels import rounded
from blockpulse.plans.registry import query
from blockpulse.session import shared_path
from blockpulse.sources import listing_schema as ls
from blockpulse.sources import readers, writers

_STAMP_SQL = "strftime(scraped_at, '%d/%m/%Y %H:%M:%S')"
_ID_SQL = f"substr(sha256(CAST(c AS VARCHAR) || {_STAMP_SQL}), 1, 24)"


#: About 100 MB of documents before compression.
ROWS_PER_FILE = 50_000


def stored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents written as compressed JSON lines and read back with their schema."""
    path = shared_path(spark, "documents")
    writers.write_json(documents(spark, sf), path, "gzip", ROWS_PER_FILE)
    return readers.read_documents(spark, path)


@query(
    "read_documents",
    f"SELECT c AS zpid, {_STAMP_SQL} AS scraped, price, state FROM scrapes WHERE state = 'NY'",
)
def read_documents(spark, sf):
    """Documents whose nested state is NY."""
    found = stored_documents(spark, sf).where("root.property.overview.state = 'NY'")
    return found.select(
        "root.zpid",
        F.col("root.extractTimestamp").alias("scraped"),
        "root.property.overview.price",
        "root.property.overview.state",
    )


@query("content_id", f"SELECT n AS scrape_id, {_ID_SQL} AS content_id FROM scrapes")
def content_id(spark, sf):
    rows = payloads(spark, sf)
    stamp = doc.scrape_stamp(F.col("scraped_at"))
    return rows.select("scrape_id", val.content_id(F.col("p.zpid"), stamp).alias("content_id"))


@query(
    "flatten_struct",
    f"""SELECT {_ID_SQL} AS root_hash_md5, {_STAMP_SQL} AS root_extractTimestamp, c AS root_zpid,
    price AS root_property_overview_price, state AS root_property_location_state,
    1 + CAST(FLOOR(amount / 120000) AS BIGINT) AS root_property_propertyFeatures_bedrooms FROM scrapes""",
)
def flatten_struct(spark, sf):
    flat = doc.flatten_struct(documents(spark, sf), "_")
    return flat.select(
        "root_hash_md5", "root_extractTimestamp", "root_zpid", "root_property_overview_price",
        "root_property_location_state", "root_property_propertyFeatures_bedrooms",
    )


@query(
    "drop_cols_like",
    "SELECT price, state, c AS zpid, n % 500 AS daysListed, n % 37 AS favoriteCount, n % 211 AS pageViewCount FROM scrapes",
)
def drop_cols_like(spark, sf):
    overview = documents(spark, sf).select("root.property.overview.*")
    return filters.drop_columns_like(overview, "coreLogic")


@query(
    "whitelist_keys",
    """SELECT c AS zpid, CAST(c % 300 AS VARCHAR) || ' Main St' AS streetAddress, state, CAST(10000 + c % 250 AS VARCHAR) AS zipcode,
    CAST(NULL AS VARCHAR) AS stateId, CAST(NULL AS VARCHAR) AS timeZone FROM scrapes""",
)
def whitelist_keys(spark, sf):
    """Only the location keys survive parsing; keys the JSON lacks are NULL."""
    text = payloads(spark, sf).select(F.to_json("p").alias("json"))
    located = text.select(F.from_json("json", ls.entity(ls.LOCATION_KEYS)).alias("l"))
    return located.select("l.zpid", "l.streetAddress", "l.state", "l.zipcode", "l.stateId", "l.timeZone")


define(
    "school_stats",
    """SELECT n, ROUND(AVG(rating), 4) AS avg_rating, ROUND(AVG(distance), 4) AS avg_distance, COUNT(rating) AS rated,
    COUNT(*) FILTER (private) AS private FROM school_items GROUP BY 1""",
)
_SCHOOLS_SQL = """SELECT s.n AS scrape_id, avg_rating, avg_distance,
    CASE WHEN s.n % 13 <> 0 THEN CAST(COALESCE(rated, 0) AS INTEGER) END AS rated,
    CASE WHEN s.n % 13 <> 0 THEN CAST(COALESCE(private, 0) AS INTEGER) END AS private
    FROM scrapes s LEFT JOIN school_stats t ON s.n = t.n"""


def _school_columns(summary: Column) -> list[Column]:
    return [
        summary["avgRating"].alias("avg_rating"),
        summary["avgDistance"].alias("avg_distance"),
        summary["schoolCount"].alias("rated"),
        summary["privateSchoolCount"].alias("private"),
    ]


@query("school_summary", _SCHOOLS_SQL)
def school_summary(spark, sf):
    return payloads(spark, sf).select("scrape_id", *_school_columns(doc.school_summary(F.col("p.schools"))))


@query(
    "repair_json",
    """SELECT s.n AS scrape_id, CASE WHEN s.n % 19 <> 0 THEN avg_rating END AS avg_rating,
    CASE WHEN s.n % 19 <> 0 THEN avg_distance END AS avg_distance,
    CASE WHEN s.n % 13 <> 0 AND s.n % 19 <> 0 THEN CAST(COALESCE(rated, 0) AS INTEGER) END AS rated,
    CASE WHEN s.n % 13 <> 0 AND s.n % 19 <> 0 THEN CAST(COALESCE(private, 0) AS INTEGER) END AS private
    FROM scrapes s LEFT JOIN school_stats t ON s.n = t.n""",
)
def repair_json(spark, sf):
    """School lists stored as Python text: repaired, parsed, summarised; broken text gives NULL."""
    as_json = F.to_json("p.schools", {"ignoreNullFields": "false"})
    python_text = F.replace(F.replace(as_json, F.lit('"'), F.lit("'")), F.lit("null"), F.lit("None"))
    text = F.when(F.col("scrape_id") % 19 == 0, F.lit("[{'name': 'cut")).otherwise(python_text)
    rows = payloads(spark, sf).select("scrape_id", text.alias("schools_text"))
    # A column of its own: the summary names the list six times, and each would parse the text again.
    parsed = rows.select("scrape_id", nested.parse_python_text(F.col("schools_text"), f"array<{ls.SCHOOL}>").alias("schools"))
    return parsed.select("scrape_id", *_school_columns(doc.school_summary(F.col("schools"))))


def _literal_facts(rows):
    """The same facts as Python prints them, with either quotes, escapes, a tuple, and texts that never end."""
    k = F.col("k").cast("string")
    kinds = [
        F.concat(F.lit("{\"agent\": \"O'Brien "), k, F.lit("\", 'note': 'None Such', \"active\": True, 'fee': None, 'tags': ('a', \"None\",), 'score': "), (F.col("k") % 7).cast("string"), F.lit(".5}")),
        F.concat(F.lit(r"{'agent': 'O\'Brien "), k, F.lit("', 'note': 'said \"True\"', 'active': False, 'fee': "), k, F.lit(r", 'tags': ['It\'s'], 'score': -1e2}")),
        F.concat(F.lit(r"{'agent': 'back\\slash "), k, F.lit("', 'note': None, 'active': None, 'fee': "), k, F.lit(".25, 'tags': [], 'score': "), (F.col("k") % 7).cast("string"), F.lit("}")),
        F.concat(F.lit("{'agent': 'never ended "), k, F.lit(", 'note': None}")),
    ]
    return rows.select("id", F.get(F.array(*kinds), (F.col("id") % 4).cast("int")).alias("fact"))


@query(
    "parse_literals",
    r"""
    SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'O''Brien ' || o_custkey WHEN 1 THEN 'O''Brien ' || o_custkey WHEN 2 THEN 'back\slash ' || o_custkey END AS agent,
           CASE o_orderkey % 4 WHEN 0 THEN 'None Such' WHEN 1 THEN 'said "True"' END AS note,
           CASE o_orderkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS active,
           CASE o_orderkey % 4 WHEN 1 THEN CAST(o_custkey AS DOUBLE) WHEN 2 THEN o_custkey + 0.25 END AS fee,
           CASE o_orderkey % 4 WHEN 0 THEN 'a|None' WHEN 1 THEN 'It''s' WHEN 2 THEN '' END AS tags,
           CASE o_orderkey % 4 WHEN 0 THEN o_custkey % 7 + 0.5 WHEN 1 THEN -100.0 WHEN 2 THEN CAST(o_custkey % 7 AS DOUBLE) END AS score
    FROM orders
    """,
)
def parse_literals(spark, sf):
    """Facts stored as Python literals: apostrophes, quotes and words like None inside texts stay as they are."""
    rows = _literal_facts(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k")))
    schema = "agent string, note string, active boolean, fee double, tags array<string>, score double"
    facts = rows.select("id", nested.parse_python_text(F.col("fact"), schema).alias("f"))
    return facts.select("id", "f.agent", "f.note", "f.active", "f.fee", F.array_join("f.tags", "|").alias("tags"), "f.score")


@query(
    "avg_price_change",
    "SELECT s.n AS scrape_id, ROUND(AVG(rate), 4) AS avg_price_change FROM scrapes s LEFT JOIN price_items i ON s.n = i.n GROUP BY 1",
)
def avg_price_change(spark, sf):
    mean = nested.mean_of_field(F.col("p.priceHistory"), "priceChangeRate", 4)
    return payloads(spark, sf).select("scrape_id", mean.alias("avg_price_change"))


@query(
    "avg_tax_increase",
    "SELECT s.n AS scrape_id, ROUND(AVG(rate), 8) AS avg_tax_increase FROM scrapes s LEFT JOIN tax_items i ON s.n = i.n GROUP BY 1",
)
def avg_tax_increase(spark, sf):
    """Unrounded in the library; rounded to eight digits here for comparison."""
    mean = nested.mean_of_field(F.col("p.taxHistory"), "valueIncreaseRate")
    return rounded(payloads(spark, sf).select("scrape_id", mean.alias("avg_tax_increase")), 8)


@query(
    "first_element_field",
    "SELECT n AS scrape_id, CASE WHEN n % 6 > 1 THEN n % 100 / 100 END AS selling_soon FROM scrapes",
)
def first_element_field(spark, sf):
    first = nested.first_field(F.col("p.sellingSoon"), "percentile")
    return payloads(spark, sf).select("scrape_id", first.alias("selling_soon"))


@query(
    "pluck",
    """SELECT n AS scrape_id, CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN 'City ' || ((c + 1) % 50)
    ELSE 'City ' || ((c + 1) % 50) || '|City ' || ((c + 2) % 50) END AS cities FROM scrapes""",
)
def pluck(spark, sf):
    names = nested.pluck(F.col("p.nearbyCities"), "name")
    return payloads(spark, sf).select("scrape_id", F.array_join(names, "|").alias("cities"))


@query(
    "drop_struct_fields",
    """SELECT n AS scrape_id, i - 1 AS pos, 'd' || i AS date, CASE WHEN i % 2 = 0 THEN 'Sold' ELSE 'Listed' END AS event,
    rate AS priceChangeRate FROM price_items""",
)
def drop_struct_fields(spark, sf):
    cleaned = doc.clean_price_history(F.col("p.priceHistory"))
    items = payloads(spark, sf).select("scrape_id", F.posexplode(cleaned).alias("pos", "item"))
    return items.select("scrape_id", F.col("pos").cast("bigint").alias("pos"), "item.*")


@query(
    "nested_filter_flatten",
    """SELECT n AS scrape_id, CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN 'p' || n || '-1' ELSE 'p' || n || '-1|p' || n || '-2' END
    AS photos, 'map' || n AS maps FROM scrapes""",
)
def nested_filter_flatten(spark, sf):
    return payloads(spark, sf).select(
        "scrape_id",
        F.array_join(doc.picture_urls(F.col("p.photos")), "|").alias("photos"),
        F.array_join(doc.map_urls(F.col("p.staticMap")), "|").alias("maps"),
    )


@query(
    "lift_and_prune",
    """SELECT n AS scrape_id, n * 10 + i AS zpid, 100000 * i AS price, i || ' Side St' AS streetAddress, 'Albany' AS city,
    'NY' AS state, '12201' AS zipcode, CASE WHEN (n + i) % 2 = 0 THEN 'u' || n || '-' || i END AS coverPhoto
    FROM (SELECT n, unnest(range(1, 1 + n % 3)) AS i FROM scrapes)""",
)
def lift_and_prune(spark, sf):
    homes = doc.pruned_homes(F.col("p.comps"))
    return payloads(spark, sf).select("scrape_id", F.inline(homes))


PAGE_KEYS = ("zpid", "price")
PAGE_PAYLOAD = "struct<" + ", ".join(f"{k}: {ls.PAYLOAD_TYPES[k]}" for k in PAGE_KEYS) + ">"


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """(scrape_id, html): pages with the payload in the first place, the second place, or nowhere."""
    n = F.col("scrape_id")
    listing = F.struct(F.col("p").alias("property"))
    two = F.to_json(F.create_map(F.lit("query"), F.lit(None).cast(_struct_type()), F.lit("listing"), listing))
    one = F.to_json(F.create_map(F.lit("listing"), listing))
    first = F.to_json(F.struct(two.alias("apiCache")))
    second = F.to_json(
        F.struct(F.struct(F.struct(one.alias("gdpClientCache")).alias("pageProps")).alias("props"))
    )
    head, tail = F.lit("<!DOCTYPE html><html><head></head><body>"), F.lit("</body></html>")

    def script(attributes: str, body: Column) -> Column:
        return F.concat(F.lit(f"<script {attributes}>"), body, F.lit("</script>"))

    search = script(ls.SEARCH_SCRIPT, F.lit('<!--{"cat1":{"total":3}}-->'))
    body = (
        F.when(n % 4 == 0, script(ls.PRIMARY_SCRIPT + ' type="application/json"', first))
        .when(n % 4 == 1, F.concat(script('id="other"', F.lit("{}")), script(ls.FALLBACK_SCRIPT, second)))
        .when(n % 4 == 2, search)
        .otherwise(F.lit("<p>gone</p>"))
    )
    return payloads(spark, sf).select("scrape_id", F.concat(head, body, tail).alias("html"))


def _struct_type():
    return ls.ddl_schema(f"struct<property: {ls.PAYLOAD}>")


@query(
    "page_payload",
    """SELECT n AS scrape_id, CASE WHEN n % 4 < 2 THEN c END AS zpid, CASE WHEN n % 4 < 2 THEN price END AS price,
    CASE n % 4 WHEN 2 THEN 'search' WHEN 3 THEN 'other' ELSE 'listing' END AS page_kind FROM scrapes""",
)
def page_payload(spark, sf):
    """Pages are written first; only the fields that are asked for are parsed."""
    stored = writers.stored(pages(spark, sf), shared_path(spark, "pages"))
    rows = stored.withColumn("payload", doc.page_payload(F.col("html"), PAGE_PAYLOAD))
    kind = doc.page_kind(F.col("html"), F.col("payload"))
    return rows.select("scrape_id", "payload.zpid", "payload.price", kind.alias("page_kind"))


_SEARCH_PAGE = """'<html><script data-zrr-shared-data-key="mobileSearchPageStore"><!--{"cat1":{"total":1}}--></script></html>'"""


@query(
    "given_page_kinds",
    "SELECT page_id, CASE WHEN page_id % 7 = 0 OR html LIKE '%mobileSearchPageStore%' THEN 'search' ELSE 'other' END AS page_kind FROM pages",
)
def given_page_kinds(spark, sf):
    """The raw web pages classified, every seventh with a search store in front; none has a listing."""
    html = F.when(F.col("page_id") % 7 == 0, F.concat(F.expr(_SEARCH_PAGE), F.col("html"))).otherwise(F.col("html"))
    rows = table(spark, sf, "pages").select("page_id", html.alias("html"))
    rows = rows.withColumn("payload", doc.page_payload(F.col("html"), PAGE_PAYLOAD))
    return rows.select("page_id", doc.page_kind(F.col("html"), F.col("payload")).alias("page_kind"))


def _joined(items: Column, *fields: Column | str) -> Column:
    """An array as text: items joined by commas, their fields by colons, `-` for a missing one."""
    def shown(item: Column) -> Column:
        return F.concat_ws(":", *[F.coalesce(item[f].cast("string"), F.lit("-")) for f in fields]) if fields else item

    return F.array_join(F.transform(items, shown), ",")


def _joined_sql(count: str, item: str, missing: str = "FALSE") -> str:
    return f"CASE WHEN {missing} THEN NULL ELSE array_to_string(list_transform(range(1, 1 + {count}), lambda i: {item}), ',') END"


def _thousandths(items: Column, field: str) -> Column:
    return F.transform(items, lambda x: x.withField(field, F.round(x[field] * 1000).cast("bigint")))


_HOME_SQL = "(n * 10 + i) || ':' || (100000 * i) || ':' || i || ' Side St:Albany:NY:12201:' || CASE WHEN (n + i) % 2 = 0 THEN 'u' || n || '-' || i ELSE '-' END"
_LISTING_SQL = {
    "hash_md5": _ID_SQL, "extractTimestamp": _STAMP_SQL, "scrapeDate": "strftime(scraped_at, '%d/%m/%Y')",
    "scrapeTime": "strftime(scraped_at, '%H:%M:%S')", "zpid": "c",
    "overview_price": "price", "overview_state": "state", "overview_zpid": "c", "overview_daysListed": "n % 500",
    "overview_favoriteCount": "n % 37", "overview_pageViewCount": "n % 211", "overview_coreLogicId": "'cl' || n",
    "location_streetAddress": "(c % 300) || ' Main St'", "location_city": "CASE WHEN c % 2 = 0 THEN 'New York' ELSE 'Albany' END",
    "location_state": "state", "location_zipcode": "CAST(10000 + c % 250 AS VARCHAR)",
    "location_longitude": "ROUND(-74.0 + (c % 100) / 1000, 4)", "location_latitude": "ROUND(40.0 + (c % 90) / 1000, 4)", "location_zpid": "c",
    "location_nearbyCities": _joined_sql("n % 3", "'City ' || (c + i) % 50"),
    "location_nearbyNeighborhoods": _joined_sql("n % 2", "'Hood ' || (c + i) % 70"),
    "location_nearbyZipcodes": _joined_sql("n % 4", "CAST(10000 + (c + i) % 250 AS VARCHAR)", "n % 9 = 0"),
    "location_utcScrapeTime": "strftime(scraped_at, '%Y-%m-%d %H:%M:%S')",
    "pricing_price": "price", "pricing_zestimate": "CASE WHEN n % 23 <> 0 THEN CAST(FLOOR(amount * (90 + n % 21) / 100) AS BIGINT) END",
    "pricing_propertyTaxRate": "(n % 5) / 4",
    "pricing_taxHistory": _joined_sql("n % 4", "'t' || i || ':' || (1000 * i) || ':' || CASE WHEN (n + i) % 4 = 0 THEN '-' ELSE CAST((n + i * 7) % 50 AS VARCHAR) END"),
    "pricing_priceHistory": _joined_sql(
        "n % 5", "'d' || i || ':' || CASE WHEN i % 2 = 0 THEN 'Sold' ELSE 'Listed' END || ':' "
        "|| CASE WHEN (n + i) % 3 = 0 THEN '-' ELSE CAST((n * i) % 11 * 10 AS VARCHAR) END", "n % 17 = 0"),
    "pricing_sellingSoon": "CASE n % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE (n % 100 * 10) || ':m1' END",
    "features_bedrooms": "1 + CAST(FLOOR(amount / 120000) AS BIGINT)", "features_bathrooms": "1 + n % 2 + FLOOR(amount / 200000)",
    "features_hasGarage": "n // 16 % 2 = 0", "features_hasHeating": "n % 3 <> 0",
    "features_homeType": "CASE c % 4 WHEN 0 THEN 'CONDO' WHEN 1 THEN 'HOUSE' WHEN 2 THEN 'TOWNHOUSE' ELSE 'COOP' END",
    "features_parkingCapacity": "n // 4 % 4", "features_yearBuilt": "1900 + c % 120",
    "agent_agentName": "CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Solo' || c ELSE 'Ann ' || c || ' Lee' END",
    "agent_agentEmail": "'a' || c || '@mail.test'", "agent_brokerName": "'Broker ' || c % 97",
    "agent_agentFirstName": "CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Solo' || c ELSE 'Ann' END",
    "agent_agentLastName": "CASE WHEN n % 5 > 1 THEN 'Lee' END", "agent_listingOriginUrl": "'listing/' || n",
    "schools": _joined_sql(
        "n % 4", "'PS ' || i || ':' || CASE WHEN (n + i) % 4 = 0 THEN 'Private' ELSE 'Public' END || ':K-5:' "
        "|| CASE WHEN (n + i) % 5 = 0 THEN '-' ELSE CAST(1 + (n * i) % 10 AS VARCHAR) END || ':' || ((n + i) % 30 * 100)", "n % 13 = 0"),
    "comps": _joined_sql("n % 3", _HOME_SQL), "nearby_homes": _joined_sql("n % 2", _HOME_SQL),
    "pictures_hiResLink": "'hi' || n", "pictures_propertyPhotos": _joined_sql("n % 3", "'p' || n || '-' || i"), "pictures_staticMap": "'map' || n",
    "pictures_streetViewMetadataUrlMediaWallLatLong": "'wall/' || c % 100",
    "pictures_streetViewMetadataUrlMediaWallAddress": "CASE WHEN n % 2 = 0 THEN 'wall-address/' || c END",
    "pictures_streetViewTileImageUrlMediumLatLong": "'tile/' || n % 10", "pictures_streetViewTileImageUrlMediumAddress": "'tile-address/' || n",
    "pictures_streetViewServiceUrl": "'service/' || n % 7",
    "census_geoId": "CASE WHEN n % 8 <> 0 THEN '36' || LPAD(CAST(c AS VARCHAR), 6, '0') END",
    "census_block": "CASE WHEN n % 8 <> 0 THEN CAST(c % 9 AS VARCHAR) END",
    "census_tract": "CASE WHEN n % 8 <> 0 THEN CAST(c * 911 % 310000 AS VARCHAR) END",
    "census_blkgrp": "CASE WHEN n % 8 <> 0 THEN CAST(c % 4 AS VARCHAR) END",
    "census_zip": "CASE WHEN n % 8 <> 0 THEN CAST(10000 + c % 250 AS VARCHAR) END",
    "census_addressFull": "CASE WHEN n % 8 <> 0 THEN (c % 300) || ' MAIN ST' END",
}


@query("listing_document", "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in _LISTING_SQL.items()) + " FROM scrapes")
def listing_document(spark, sf):
    """The whole document, every part that the payloads fill."""
    rows = doc.typed_listing(payloads(spark, sf, census=True), "p", "scraped_at", "census").select("root.*").select("*", "property.*")
    home = ("zpid", "price", "streetAddress", "city", "state", "zipcode", "coverPhoto")
    shown = {
        "location_longitude": F.round("location.longitude", 4), "location_latitude": F.round("location.latitude", 4),
        **{f"location_{k}": _joined(F.col(f"location.{k}")) for k in ("nearbyCities", "nearbyNeighborhoods", "nearbyZipcodes")},
        "pricing_taxHistory": _joined(
            F.transform(_thousandths(F.col("pricing.taxHistory"), "valueIncreaseRate"), lambda x: x.withField("value", x["value"].cast("bigint"))),
            "time", "value", "valueIncreaseRate"),
        "pricing_priceHistory": _joined(_thousandths(F.col("pricing.priceHistory"), "priceChangeRate"), "date", "event", "priceChangeRate"),
        "pricing_sellingSoon": _joined(_thousandths(F.col("pricing.sellingSoon"), "percentile"), "percentile", "modelId"),
        "schools": _joined(_thousandths(F.col("schools.schools"), "distance"), "name", "type", "gradeRange", "rating", "distance"),
        "comps": _joined(F.col("compNearbyHomes.comps"), *home), "nearby_homes": _joined(F.col("compNearbyHomes.nearby_homes"), *home),
        "pictures_propertyPhotos": _joined(F.col("pictures.propertyPhotos")), "pictures_staticMap": _joined(F.col("pictures.staticMap")),
        "census_zip": F.col("census.addressComponents")["zip"],
    }
    parts = {"features": "propertyFeatures", "agent": "listingAgent"}

    def leaf(name: str) -> Column:
        part, _, key = name.partition("_")
        return F.col(f"{parts.get(part, part)}.{key}") if key and part != "hash" else F.col(name)

    return rows.select(*[(shown[n] if n in shown else leaf(n)).alias(n) for n in _LISTING_SQL])


@query(
    "census_pick",
    """SELECT s_suppkey AS station, '36' || LPAD(CAST(s_suppkey AS VARCHAR), 6, '0') AS geoId, CAST(s_suppkey % 9 AS VARCHAR) AS block,
    CAST(s_suppkey * 911 % 310000 AS VARCHAR) AS tract, CAST(s_suppkey % 4 AS VARCHAR) AS blkgrp
    FROM supplier WHERE s_suppkey % 10 <> 0
    UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 10 = 0""",
)
def census_pick(spark, sf):
    """First block record of a geocoder answer; an empty answer gives NULLs."""
    key = F.col("s_suppkey")
    block = F.struct(
        F.concat(F.lit("36"), F.lpad(key.cast("string"), 6, "0")).alias("GEOID"),
        (key % 9).cast("string").alias("BLOCK"),
        (key * 911 % 310000).cast("string").alias("TRACT"),
        (key % 4).cast("string").alias("BLKGRP"),
    )
    blocks = F.when(key % 10 == 0, F.array().cast(f"array<{_BLOCK}>")).otherwise(F.array(block, block))
    answer = F.to_json(F.struct(F.create_map(F.lit("2020 Census Blocks"), blocks).alias("geographies")))
    rows = table(spark, sf, "supplier").select(key.alias("station"), answer.alias("answer"))
    parsed = F.from_json("answer", f"geographies struct<`2020 Census Blocks`: array<{_BLOCK}>>")
    first = F.get(parsed["geographies"]["2020 Census Blocks"], F.lit(0))
    return rows.select("station", first.alias("b")).select(
        "station",
        F.col("b.GEOID").alias("geoId"),
        F.col("b.BLOCK").alias("block"),
        F.col("b.TRACT").alias("tract"),
        F.col("b.BLKGRP").alias("blkgrp"),
    )


_BLOCK = "struct<GEOID: string, BLOCK: string, TRACT: string, BLKGRP: string>"


# --- newest and deduplicated -----------------------------------------------------------------


@query(
    "dedupe_latest",
    f"""SELECT c AS zpid, {_STAMP_SQL} AS extract_ts, price
    FROM scrapes QUALIFY ROW_NUMBER() OVER (PARTITION BY c ORDER BY scraped_at DESC) = 1""",
)
def dedupe_latest(spark, sf):
    scrapes = documents(spark, sf).select(
        "root.zpid", F.col("root.extractTimestamp").alias("extract_ts"), "root.property.overview.price"
    )
    return doc.newest_scrape(scrapes, "zpid", "extract_ts")


@query(
    "dedupe",
    "SELECT o_custkey AS customer, o_orderkey AS sale_id, o_totalprice AS price FROM orders "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
)
def dedupe(spark, sf):
    """One row per customer: the highest price, the smallest key on ties."""
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("sale_id"), F.col("o_totalprice").alias("price")
    )
    return win.newest_per_key(rows, "customer", [F.col("price"), -F.col("sale_id")])


@query("value_diff", "SELECT n AS scrape_id, CASE WHEN n % 23 <> 0 THEN CAST(FLOOR(amount * (90 + n % 21) / 100) AS BIGINT) - price END AS zestimate_diff FROM scrapes")
def value_diff(spark, sf):
    return payloads(spark, sf).select("scrape_id", (F.col("p.zestimate") - F.col("p.price")).alias("zestimate_diff"))


@query(
    "clean_fee",
    "SELECT n AS scrape_id, CASE n % 4 WHEN 0 THEN CAST(n AS DOUBLE) WHEN 1 THEN n + 0.5 END AS hoa_fee FROM scrapes",
)
def clean_fee(spark, sf):
    fee = val.clean_fee(F.col("p.resoFacts.hoaFee"))
    return payloads(spark, sf).select("scrape_id", fee.alias("hoa_fee"))


@query(
    "top_groups",
    """SELECT broker, COUNT(*) AS listings FROM (SELECT 'Broker ' || (c % 97) AS broker FROM scrapes)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_groups(spark, sf):
    rows = payloads(spark, sf).select(F.col("p.attributionInfo.brokerName").alias("broker"))
    return aggregates.top_groups(rows, "broker", 10, "listings")


# --- leads -----------------------------------------------------------------------------------

define(
    "top_leads",
    """SELECT * FROM leads WHERE agent_name NOT LIKE '%Team%'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY agent_name ORDER BY price DESC, lead_id) = 1""",
)
_LAST_SQL = "list_extract(str_split(list_extract(str_split(agent_name, '-'), -1), ' '), -1)"
_FIRST_SQL = "split_part(agent_name, ' ', 1)"


@query(
    "lead_filters",
    """SELECT lead_id, agent_name, agent_email, days_listed FROM leads WHERE agent_name NOT LIKE '%Team%'
    AND agent_email LIKE '%@%' AND days_listed < 365""",
)
def lead_filters(spark, sf):
    rows = filters.not_team(feed(spark, sf, "leads"), "agent_name")
    kept = filters.lead_filters(rows, "agent_email", "days_listed")
    return kept.select("lead_id", "agent_name", "agent_email", "days_listed")


def lead_list(rows: DataFrame) -> DataFrame:
    """Highest-priced lead per agent, then the contact and age filters, dearest first."""
    best = win.newest_per_key(filters.not_team(rows, "agent_name"), "agent_name", [F.col("price"), -F.col("lead_id")])
    kept = filters.lead_filters(best, "agent_email", "days_listed")
    name = F.col("agent_name")
    return kept.orderBy(F.desc("price"), "lead_id").select(
        F.col("street").alias("Street"),
        val.currency(F.col("price")).alias("Price"),
        F.col("city").alias("City"),
        F.col("zipcode").alias("Zipcode"),
        F.col("state").alias("State"),
        F.element_at(F.split(name, " "), 1).alias("First"),
        val.lead_last_name(name).alias("Last"),
        F.col("agent_email").alias("AgentEmail"),
        F.col("agent_phone").alias("AgentPhoneNumber"),
        F.col("days_listed").alias("DaysListed"),
        F.col("lead_id").alias("LeadId"),
    )


@query(
    "lead_list",
    f"""SELECT street AS Street, format('${{:,}}', CAST(price AS BIGINT)) AS Price, city AS City, zipcode AS Zipcode,
    state AS State, {_FIRST_SQL} AS First, {_LAST_SQL} AS Last, agent_email AS AgentEmail, agent_phone AS AgentPhoneNumber,
    days_listed AS DaysListed, lead_id AS LeadId
    FROM top_leads WHERE agent_email LIKE '%@%' AND days_listed < 365""",
)
def lead_list_query(spark, sf):
    return lead_list(feed(spark, sf, "leads"))


@query(
    "split_name",
    f"""SELECT lead_id, {_FIRST_SQL} AS first_name,
    CASE WHEN agent_name LIKE '% %' THEN list_extract(str_split(agent_name, ' '), -1) END AS last_name,
    {_LAST_SQL} AS lead_last_name FROM leads""",
)
def split_name(spark, sf):
    name = F.col("agent_name")
    return feed(spark, sf, "leads").select(
        "lead_id",
        val.first_name(name).alias("first_name"),
        val.last_name(name).alias("last_name"),
        val.lead_last_name(name).alias("lead_last_name"),
    )


@query("format_currency", "SELECT lead_id, format('${:,}', CAST(price AS BIGINT)) AS price FROM leads")
def format_currency(spark, sf):
    return feed(spark, sf, "leads").select("lead_id", val.currency(F.col("price")).alias("price"))


# --- routing ---------------------------------------------------------------------------------


@query(
    "route_sinks",
    """SELECT 'all' AS dest, c AS zpid, price, state FROM scrapes
    UNION ALL SELECT CASE WHEN state = 'NY' THEN 'nyc' ELSE 'not_nyc' END, c, price, state FROM scrapes""",
)
def route_sinks(spark, sf):
    """Every document to `all` and to one of two branches, written partitioned, read back."""
    rows = documents(spark, sf).select("root.zpid", "root.property.overview.price", "root.property.overview.state")
    path = shared_path(spark, "routed")
    writers.write_partitioned(doc.routed(rows, F.col("state") == "NY"), path, ["dest"])
    return spark.read.parquet(path).select("dest", "zpid", "price", "state")
