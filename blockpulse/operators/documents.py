"""Listing documents: assembling, flattening, deduplicating and routing."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockpulse.functions import nested
from blockpulse.functions.calendar import scrape_timestamp
from blockpulse.functions.values import content_id, first_name, last_name
from blockpulse.operators.windows import newest_per_key
from blockpulse.sources import listing_schema as ls


def struct_leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all non-struct fields; arrays are leaves."""
    for f in schema:
        path = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType):
            yield from struct_leaves(f.dataType, path)
        else:
            yield path


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per leaf, named by its path."""
    return df.select(
        *[F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path)) for path in struct_leaves(df.schema)]
    )


def whitelist(source: Column, available: list[str], keys: list[str]) -> Column:
    """Struct of exactly these keys; a key the source lacks becomes NULL."""
    return F.struct(
        *[(source[k] if k in available else F.lit(None).cast(ls.key_type(k))).alias(k) for k in keys]
    )


def picture_urls(photos: Column, width: int = ls.PHOTO_WIDTH) -> Column:
    """URLs of the JPEG versions of one width, all photos in order."""
    per_photo = F.transform(
        photos,
        lambda p: F.transform(
            F.filter(p["mixedSources"]["jpeg"], lambda j: j["width"] == width), lambda j: j["url"]
        ),
    )
    return F.flatten(per_photo)


def map_urls(static_map: Column, width: int = ls.MAP_WIDTH) -> Column:
    return F.transform(F.filter(static_map["sources"], lambda s: s["width"] == width), lambda s: s["url"])


def pruned_homes(homes: Column) -> Column:
    """Comparable homes: address fields moved up, noise removed, first photo as cover."""

    def prune(home: Column) -> Column:
        return F.named_struct(
            F.lit("zpid"), home["zpid"],
            F.lit("price"), home["price"],
            *[x for k in ("streetAddress", "city", "state", "zipcode") for x in (F.lit(k), home["address"][k])],
            F.lit("coverPhoto"), nested.first_field(home["miniCardPhotos"], "url"),
        )

    return F.transform(homes, prune)


def clean_price_history(history: Column) -> Column:
    return nested.drop_fields(history, *ls.PRICE_HISTORY_NOISE)


def agent_details(payload: Column) -> Column:
    """Agent keys plus first and last name; the origin URL comes from the payload itself."""
    info = payload["attributionInfo"]
    return F.struct(
        *[
            (payload["postingUrl"] if k == "listingOriginUrl" else info[k]).alias(k)
            for k in ls.AGENT_KEYS
        ],
        first_name(info["agentName"]).alias("agentFirstName"),
        last_name(info["agentName"]).alias("agentLastName"),
    )


def census_details(answer: Column) -> Column:
    """The census block of a geocoder's first match; NULL where there is no match."""
    match = F.get(answer, F.lit(0))
    block = F.get(match["geographies"]["2020 Census Blocks"], F.lit(0))
    parts = [block["GEOID"], block["BLOCK"], block["TRACT"], block["BLKGRP"], match["addressComponents"], match["matchedAddress"]]
    return F.when(match.isNotNull(), F.struct(*[c.alias(k) for k, c in zip(ls.CENSUS_KEYS, parts)]))


def listing_entities(payload: Column, moment: Column, answer: Column | None = None) -> dict[str, Column]:
    """The parts of a listing, from its payload, the time of its scrape and a geocoder's answer."""
    top = list(ls.PAYLOAD_TYPES)
    location = whitelist(payload, top, ls.LOCATION_KEYS).withField("utcScrapeTime", F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
    for nearby in ("nearbyCities", "nearbyNeighborhoods", "nearbyZipcodes"):
        location = location.withField(nearby, nested.pluck(payload[nearby], "name"))
    pictures = whitelist(payload, top, ls.PICTURE_KEYS)
    pictures = pictures.withField("propertyPhotos", picture_urls(payload["photos"]))
    return {
        "location": location,
        "pricing": whitelist(payload, top, ls.PRICING_KEYS).withField(
            "priceHistory", clean_price_history(payload["priceHistory"])
        ),
        "propertyFeatures": payload["resoFacts"],
        "listingAgent": agent_details(payload),
        "schools": F.struct(payload["schools"].alias("schools")),
        "compNearbyHomes": F.struct(
            pruned_homes(payload["comps"]).alias("comps"), pruned_homes(payload["nearbyHomes"]).alias("nearby_homes")
        ),
        "pictures": pictures.withField("staticMap", map_urls(payload["staticMap"])),
        "census": census_details(F.lit(None).cast(ls.CENSUS_ANSWER) if answer is None else answer),
    }


def scrape_stamp(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy HH:mm:ss")


def _rooted(rows: DataFrame, payload: str, moment: str, parts: dict[str, Column]) -> DataFrame:
    p, stamp = F.col(payload), scrape_stamp(F.col(moment))
    overview = F.struct(*[p[k].alias(k) for k in ls.OVERVIEW_KEYS])
    return rows.select(
        F.struct(
            content_id(p["zpid"], stamp).alias("hash_md5"),
            stamp.alias("extractTimestamp"),
            F.substring(stamp, 1, 10).alias("scrapeDate"),
            F.substring(stamp, 12, 8).alias("scrapeTime"),
            p["zpid"].alias("zpid"),
            F.struct(overview.alias("overview"), *[c.alias(n) for n, c in parts.items()]).alias("property"),
        ).alias("root")
    )


def typed_listing(rows: DataFrame, payload: str, moment: str, answer: str | None = None) -> DataFrame:
    """The full listing document as one `root` struct; `answer` names a column of geocoder answers."""
    census = F.col(answer) if answer else None
    return _rooted(rows, payload, moment, listing_entities(F.col(payload), F.col(moment), census))


def listing_document(rows: DataFrame, payload: str, moment: str) -> DataFrame:
    """Documents as they are stored: whitelisted entities under the document schema.

    Every struct is built field by field, so a query that needs one field computes one field.
    """
    p, top = F.col(payload), list(ls.PAYLOAD_TYPES)
    parts = {
        "location": whitelist(p, top, ls.LOCATION_KEYS),
        "propertyFeatures": p["resoFacts"],
        "pricing": whitelist(p, top, ls.PRICING_KEYS),
        "listingAgent": p["attributionInfo"],
        "schools": F.struct(p["schools"].alias("schools")),
    }
    return _rooted(rows, payload, moment, parts)


def newest_scrape(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """Newest row per listing, by parsed scrape time; equal times fall back to the row's content."""
    others = [F.col(c) for c in df.columns if c not in (key, stamp)]
    tie_break = F.xxhash64(*others) if others else F.lit(0)
    return newest_per_key(df, key, [scrape_timestamp(F.col(stamp)), tie_break])


def page_payload(html: Column, payload_ddl: str) -> Column:
    """Payload struct embedded in a page: first script location, then the second, else NULL."""
    cache = f"map<string, struct<property: {payload_ddl}>>"
    primary = F.from_json(nested.script_body(html, ls.PRIMARY_SCRIPT), "apiCache string")["apiCache"]
    fallback = F.from_json(
        nested.script_body(html, ls.FALLBACK_SCRIPT), "props struct<pageProps: struct<gdpClientCache: string>>"
    )["props"]["pageProps"]["gdpClientCache"]
    # A cache also holds entries of other queries: the listing is the entry that has a property.
    def listing(text: Column) -> Column:
        entries = F.map_values(F.from_json(text, cache))
        return F.get(F.filter(entries, lambda e: e["property"].isNotNull()), F.lit(0))["property"]

    return F.coalesce(listing(primary), listing(fallback))


def page_kind(html: Column, payload: Column) -> Column:
    store = F.from_json(nested.script_body(html, ls.SEARCH_SCRIPT), "map<string, string>")
    return (
        F.when(F.map_contains_key(store, "cat1"), "search").when(payload.isNotNull(), "listing").otherwise("other")
    )


def school_summary(schools: Column) -> Column:
    return F.struct(
        nested.mean_of_field(schools, "rating", 4).alias("avgRating"),
        nested.mean_of_field(schools, "distance", 4).alias("avgDistance"),
        nested.count_of_field(schools, "rating").alias("schoolCount"),
        nested.count_where_field(schools, "type", "Private").alias("privateSchoolCount"),
    )


def routed(df: DataFrame, in_city: Column) -> DataFrame:
    """Every document once for `all` and once for `nyc` or `not_nyc`: a `dest` column."""
    branch = F.when(F.coalesce(in_city, F.lit(False)), "nyc").otherwise("not_nyc")
    return df.withColumn("dest", F.explode(F.array(F.lit("all"), branch)))
