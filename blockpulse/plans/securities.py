"""Security identifiers and daily market rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from blockpulse.fixtures import feed
from blockpulse.functions.values import cusip8 as without_check_digit
from blockpulse.operators import filters, joins
from blockpulse.oracle import define
from blockpulse.plans.registry import query

# The test tables hold made-up brands, so the ticker list and dates are parameters here.
TICKERS = [f"Brand#{n}" for n in range(1, 12)]
FIRST, LAST = date(1996, 1, 1), date(2000, 3, 1)
_TICKERS_SQL = ", ".join(f"'{t}'" for t in TICKERS)
_RANGE_SQL = f"DATE '{FIRST}' AND DATE '{LAST}'"

define(
    "newest_security",
    f"""SELECT tic, best.gvkey AS gvkey, best.cusip AS cusip, best.conm AS conm, best.datadate AS datadate
    FROM (SELECT tic, max(struct_pack(datadate := datadate, gvkey := gvkey, cusip := cusip, conm := conm)) AS best
          FROM secd WHERE tic IN ({_TICKERS_SQL}) GROUP BY tic)""",
)
define(
    "security_mapping",
    """SELECT infocode, ds2cusipchg.cusip AS cusip, newest_security.cusip AS cusip_tm, conm, gvkey, tic AS ticker
    FROM newest_security, ds2cusipchg WHERE starts_with(newest_security.cusip, ds2cusipchg.cusip)
    AND length(newest_security.cusip) = length(ds2cusipchg.cusip) + 1""",
)


@query("cusip8", "SELECT DISTINCT cusip, LEFT(cusip, LENGTH(cusip) - 1) AS cusip8 FROM secd")
def cusip8(spark, sf):
    rows = feed(spark, sf, "secd_newest").select("cusip")
    return rows.select("cusip", without_check_digit(F.col("cusip")).alias("cusip8"))


@query("latest_per_key", "SELECT gvkey, tic, cusip, conm, datadate FROM newest_security")
def latest_per_key(spark, sf):
    newest = joins.newest_security(feed(spark, sf, "secd_newest"), TICKERS)
    return newest.select("gvkey", "tic", "cusip", "conm", "datadate")


def _mapping(spark, sf):
    newest = joins.newest_security(feed(spark, sf, "secd_newest"), TICKERS)
    return joins.security_map(feed(spark, sf, "ds2cusipchg"), newest)


@query("security_map", "SELECT infocode, cusip, cusip_tm, conm, gvkey, ticker FROM security_mapping")
def security_map(spark, sf):
    return _mapping(spark, sf).select("infocode", "cusip", "cusip_tm", "conm", "gvkey", "ticker")


@query(
    "semi_filter",
    "SELECT line_id, infocode, marketdate FROM ds2dsf WHERE infocode IN (SELECT infocode FROM security_mapping)",
)
def semi_filter(spark, sf):
    market = feed(spark, sf, "ds2dsf").select("line_id", "infocode", "marketdate")
    return joins.semi_filter(market, _mapping(spark, sf), "infocode")


@query(
    "security_daily",
    f"""SELECT d.infocode, d.marketdate, d.close_price, m.cusip, m.ticker, m.gvkey, m.conm
    FROM ds2dsf d LEFT JOIN security_mapping m ON d.infocode = m.infocode
    WHERE d.infocode IN (SELECT infocode FROM security_mapping) AND d.marketdate BETWEEN {_RANGE_SQL}""",
)
def security_daily(spark, sf):
    market = feed(spark, sf, "ds2dsf").select("infocode", "marketdate", "close_price")
    daily = joins.security_daily(market, _mapping(spark, sf), FIRST, LAST)
    return daily.select("infocode", "marketdate", "close_price", "cusip", "ticker", "gvkey", "conm")


@query("date_range", f"SELECT line_id, infocode, marketdate FROM ds2dsf WHERE marketdate BETWEEN {_RANGE_SQL}")
def date_range(spark, sf):
    market = feed(spark, sf, "ds2dsf").select("line_id", "infocode", "marketdate")
    return filters.date_range(market, "marketdate", FIRST, LAST)
