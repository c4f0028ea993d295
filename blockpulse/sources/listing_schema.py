"""Schema of listing documents and of the payload embedded in listing pages."""

from __future__ import annotations

from pyspark.sql import types as T

# Keys kept per entity, in order.
LOCATION_KEYS = [
    "streetAddress", "city", "state", "stateId", "zipcode", "zipPlusFour", "cityId", "longitude", "latitude",
    "timeZone", "zpid", "neighborhoodRegion", "nearbyCities", "nearbyNeighborhoods", "nearbyZipcodes",
    "utcScrapeTime",
]
PRICING_KEYS = [
    "price", "zestimate", "zestimateLowPercent", "zestimateHighPercent", "rentZestimate", "restimateLowPercent",
    "restimateHighPercent", "taxHistory", "priceHistory", "mortgageZHLRates", "propertyTaxRate", "sellingSoon",
    "foreclosureTypes",
]
FEATURE_KEYS = [
    "isNewConstruction", "associationFee", "hoaFee", "hoaFeeTotal", "buildingName", "buyerAgencyCompensation",
    "buyerAgencyCompensationType", "hasAssociation", "basement", "bathrooms", "bathroomsFull", "bathroomsHalf",
    "bedrooms", "hasGarage", "homeType", "garageParkingCapacity", "fireplaces", "hasFireplace", "parkingCapacity",
    "pricePerSquareFoot", "stories", "structureType", "hasPrivatePool", "lotSize", "hasSpa", "hasView",
    "hasWaterfront", "hasCooling", "hasHeating", "yearBuilt", "zoning", "zoningDescription",
]
AGENT_KEYS = [
    "agentName", "agentEmail", "agentLicenseNumber", "agentPhoneNumber", "brokerName", "brokerPhoneNumber",
    "buyerAgentName", "buyerBrokerageName", "coAgentName", "coAgentNumber", "lastChecked", "lastUpdated",
    "listingOffices", "listingAgents", "mlsName", "mlsId", "listingOriginUrl",
]
SCHOOL_KEYS = ["name", "type", "gradeRange", "rating", "distance"]
PICTURE_KEYS = [
    "hiResLink", "propertyPhotos", "staticMap", "streetViewMetadataUrlMediaWallLatLong",
    "streetViewMetadataUrlMediaWallAddress", "streetViewTileImageUrlMediumLatLong",
    "streetViewTileImageUrlMediumAddress", "streetViewServiceUrl",
]
CENSUS_KEYS = ["geoId", "block", "tract", "blkgrp", "addressComponents", "addressFull"]

PRICE_HISTORY_NOISE = ["buyerAgent", "sellerAgent", "showCountyLink", "attributeSource"]
HOME_NOISE = [
    "livingAreaUnits", "miniCardPhotos", "livingAreaUnitsShort", "listingMetadata", "formattedChip",
    "attributionInfo", "providerListingID", "address",
]
PHOTO_WIDTH = 1536
MAP_WIDTH = 768

# Where a page keeps its payload, first and second choice, and what marks a search page.
PRIMARY_SCRIPT = 'id="hdpApolloPreloadedData"'
FALLBACK_SCRIPT = 'id="__NEXT_DATA__"'
SEARCH_SCRIPT = 'data-zrr-shared-data-key="mobileSearchPageStore"'

_TYPES: dict[str, str] = {
    **dict.fromkeys(["zpid", "price", "zestimate", "yearBuilt", "bedrooms", "parkingCapacity"], "bigint"),
    **dict.fromkeys(["longitude", "latitude", "propertyTaxRate", "bathrooms"], "double"),
    **dict.fromkeys(["hasGarage", "hasHeating"], "boolean"),
    **dict.fromkeys(["nearbyCities", "nearbyNeighborhoods", "nearbyZipcodes"], "array<struct<name: string>>"),
    "taxHistory": "array<struct<time: string, value: double, valueIncreaseRate: double>>",
    "priceHistory": "array<struct<date: string, event: string, priceChangeRate: double, buyerAgent: string, "
    "sellerAgent: string, showCountyLink: boolean, attributeSource: string>>",
    "sellingSoon": "array<struct<percentile: double, modelId: string>>",
    "rating": "int",
    "distance": "double",
    "addressComponents": "map<string, string>",
}


def entity(keys: list[str]) -> str:
    """DDL of a struct holding exactly these keys, all nullable."""
    return "struct<" + ", ".join(f"{k}: {_TYPES.get(k, 'string')}" for k in keys) + ">"


SCHOOL = entity(SCHOOL_KEYS)
HOME = (
    "struct<zpid: bigint, price: bigint, address: struct<streetAddress: string, city: string, state: string, "
    "zipcode: string>, miniCardPhotos: array<struct<url: string>>, livingAreaUnits: string, "
    "livingAreaUnitsShort: string, listingMetadata: string, formattedChip: string, attributionInfo: string, "
    "providerListingID: string>"
)
# A geocoder's answer for one address, and what is kept of its first match.
CENSUS_BLOCK = "struct<GEOID: string, BLOCK: string, TRACT: string, BLKGRP: string>"
CENSUS_ANSWER = (
    f"array<struct<geographies: struct<`2020 Census Blocks`: array<{CENSUS_BLOCK}>>, "
    "addressComponents: map<string, string>, matchedAddress: string>>"
)
SIZED_IMAGE = "struct<url: string, width: int>"

_TOP_LEVEL = {k: _TYPES.get(k, "string") for k in [*LOCATION_KEYS, *PRICING_KEYS, *PICTURE_KEYS]}
_TOP_LEVEL |= {
    "daysListed": "bigint",
    "favoriteCount": "bigint",
    "pageViewCount": "bigint",
    "coreLogicId": "string",
    "postingUrl": "string",
    "resoFacts": entity(FEATURE_KEYS),
    "attributionInfo": entity(AGENT_KEYS),
    "schools": f"array<{SCHOOL}>",
    "photos": f"array<struct<mixedSources: struct<jpeg: array<{SIZED_IMAGE}>>>>",
    "staticMap": f"struct<sources: array<{SIZED_IMAGE}>>",
    "comps": f"array<{HOME}>",
    "nearbyHomes": f"array<{HOME}>",
}
PAYLOAD = "struct<" + ", ".join(f"{k}: {t}" for k, t in _TOP_LEVEL.items()) + ">"

OVERVIEW_KEYS = ["price", "state", "zpid", "daysListed", "favoriteCount", "pageViewCount", "coreLogicId"]
OVERVIEW = "struct<" + ", ".join(f"{k}: {_TOP_LEVEL[k]}" for k in OVERVIEW_KEYS) + ">"
DOCUMENT = (
    "struct<root: struct<hash_md5: string, extractTimestamp: string, scrapeDate: string, scrapeTime: string, "
    f"zpid: bigint, property: struct<overview: {OVERVIEW}, location: {entity(LOCATION_KEYS)}, "
    f"propertyFeatures: {entity(FEATURE_KEYS)}, pricing: {entity(PRICING_KEYS)}, "
    f"listingAgent: {entity(AGENT_KEYS)}, schools: struct<schools: array<{SCHOOL}>>>>>"
)


def key_type(key: str) -> str:
    """Type of an entity key; text unless listed."""
    return _TYPES.get(key, "string")


PAYLOAD_TYPES = _TOP_LEVEL


def ddl_schema(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)
