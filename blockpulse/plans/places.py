"""Lookups of places by coordinates and by misspelt addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockpulse.fixtures import table
from blockpulse.operators import geocoding
from blockpulse.oracle import define
from blockpulse.plans.registry import query


def _spread(number: str, step: int, prime: int) -> str:
    """A number as a fraction in [0, 1), the same on both engines."""
    return f"CAST({number} * {step} % {prime} AS DOUBLE) / {prime}"


def _coordinates(number: str) -> dict[str, str]:
    """A place for each number: a third of them crowded around one corner, a few far outside."""
    return {
        "lon": f"CASE WHEN {number} % 3 = 0 THEN -73.99 + {_spread(number, 6151, 10007)} * 0.002 WHEN {number} % 101 = 1 THEN -80 + {_spread(number, 733, 1009)} "
        f"ELSE -74.2 + {_spread(number, 7919, 100003)} * 0.5 END",
        "lat": f"CASE WHEN {number} % 3 = 0 THEN 40.75 + {_spread(number, 4409, 9973)} * 0.002 WHEN {number} % 101 = 1 THEN 35 + {_spread(number, 587, 997)} "
        f"ELSE 40.5 + {_spread(number, 3571, 99991)} * 0.4 END",
    }


#: Degrees of longitude are this much shorter than those of latitude here.
SHRINK = 0.7581
_RIDE, _BLOCK = _coordinates("event_id"), _coordinates("(p_partkey + 7)")
_BLOCK_ID = "'B' || CAST(p_partkey AS STRING)"

define("ride_spots", f"SELECT event_id AS ride_id, ({_RIDE['lon']}) * {SHRINK} AS x, {_RIDE['lat']} AS y FROM events")
define("block_spots", f"SELECT {_BLOCK_ID} AS block, ({_BLOCK['lon']}) * {SHRINK} AS x, {_BLOCK['lat']} AS y FROM part")


@query(
    "nearest_block",
    """
    SELECT ride_id, arg_min(block, (d, block)) AS block, ROUND(SQRT(MIN(d)), 9) AS distance
    FROM (SELECT ride_id, block, (b.x - r.x) * (b.x - r.x) + (b.y - r.y) * (b.y - r.y) AS d FROM ride_spots r, block_spots b) GROUP BY ride_id
    """,
)
def nearest_block(spark, sf):
    """The nearest known block of every ride's start."""
    rides = table(spark, sf, "events").selectExpr("event_id AS ride_id", f"({_RIDE['lon']}) * {SHRINK} AS x", f"{_RIDE['lat']} AS y")
    blocks = table(spark, sf, "part").selectExpr(f"{_BLOCK_ID} AS block", f"({_BLOCK['lon']}) * {SHRINK} AS x", f"{_BLOCK['lat']} AS y")
    found = geocoding.nearest(rides, blocks, "ride_id", "block")
    return found.withColumn("distance", F.round("distance", 9))


# An address per part; the typed one has no, one or two typing errors, or is another address altogether.
_ADDRESS = (
    "UPPER(CAST(p_partkey * 37 % 9000 + 100 AS STRING) || ' ' || "
    "TRANSLATE(SUBSTRING(MD5(CAST(p_partkey AS STRING)), 1, 7), '0123456789', 'ghijklmnop') || ' ' || p_name)"
)
_TYPED = f"""CASE p_partkey % 6
    WHEN 0 THEN {_ADDRESS}
    WHEN 1 THEN SUBSTRING({_ADDRESS}, 1, 6) || SUBSTRING({_ADDRESS}, 8)
    WHEN 2 THEN SUBSTRING({_ADDRESS}, 1, 7) || 'QX' || SUBSTRING({_ADDRESS}, 8)
    WHEN 3 THEN SUBSTRING({_ADDRESS}, 1, 8) || SUBSTRING({_ADDRESS}, 10, 1) || SUBSTRING({_ADDRESS}, 9, 1) || SUBSTRING({_ADDRESS}, 11)
    WHEN 4 THEN REVERSE({_ADDRESS}) ELSE SUBSTRING({_ADDRESS}, 1, 4) END"""
# Some places have a short name, and some are not known.
_KNOWN = f"CASE WHEN p_partkey % 7 = 3 THEN SUBSTRING({_ADDRESS}, 1, 5) ELSE {_ADDRESS} END"

define("typed_addresses", f"SELECT p_partkey AS request, {_TYPED} AS address FROM part")
define("known_addresses", f"SELECT p_partkey AS place, {_KNOWN} AS address FROM part WHERE p_partkey % 10 <> 9")


@query(
    "geocode_similar",
    """
    WITH near AS (
      SELECT t.request, k.place, levenshtein(t.address, k.address) AS edits FROM typed_addresses t, known_addresses k
      WHERE ABS(LENGTH(t.address) - LENGTH(k.address)) <= 2 AND levenshtein(t.address, k.address) <= 2)
    SELECT t.request, t.address, MIN(n.edits) AS edits, arg_min(n.place, (n.edits, n.place)) AS place
    FROM typed_addresses t LEFT JOIN near n USING (request) GROUP BY t.request, t.address
    """,
)
def geocode_similar(spark, sf):
    """Typed addresses matched to the known address that is fewest typing errors away, two at most."""
    parts = table(spark, sf, "part")
    typed = parts.selectExpr("p_partkey AS request", f"{_TYPED} AS address")
    known = parts.where("p_partkey % 10 <> 9").selectExpr("p_partkey AS place", f"{_KNOWN} AS address")
    found = geocoding.most_similar(typed, known, "address", "place")
    return found.select("request", "address", F.col("edits").cast("bigint").alias("edits"), "place")
