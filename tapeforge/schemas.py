"""The canonical security: its 37 flat fields in groups, and their Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

#: Amounts: scale 14 leaves room for an exact mean of two.
AMOUNT = T.DecimalType(32, 14)
RATE = T.DecimalType(18, 8)

IDENTIFIERS = ["isin", "cusip", "cik", "share_class_figi"]
UNSIGNED = (
    "last_price market_cap fifty_two_week_min fifty_two_week_max dividend_yield market_volume held_insiders held_institutions "
    "short_interest share_float shares_outstanding revenue_per_share total_debt revenue"
).split()
SIGNED = (
    "profit_margin gross_margin operating_margin free_cash_flow operating_cash_flow return_on_equity return_on_assets "
    "performance_1_year ebitda trailing_pe price_to_book trailing_eps"
).split()
AMOUNTS = [*UNSIGNED, *SIGNED]
MODES = ["symbol", "isin", "cusip", "cik", "currency", "analyst_rating"]
FUZZY = ["name", "industry", "sector"]
#: Identity first, then what is known of the security's finances.
IDENTITY = ["name", "symbol", "share_class_figi", "isin", "cusip", "cik"]
FINANCIALS = ["mics", "currency", *AMOUNTS, "analyst_rating", "industry", "sector"]
FIELDS = [*IDENTITY, *FINANCIALS]
REQUIRED = ["name", "symbol"]

#: Feeds in order of precedence.
FEEDS = ["euronext", "xetra", "lse", "sec"]


def field_type(field: str) -> T.DataType:
    if field == "mics":
        return T.ArrayType(T.StringType())
    return AMOUNT if field in AMOUNTS else T.StringType()


RAW = T.StructType([T.StructField(f, field_type(f)) for f in FIELDS])
CANONICAL = T.StructType(
    [T.StructField(g, T.StructType([T.StructField(f, field_type(f)) for f in fields])) for g, fields in (("identity", IDENTITY), ("financials", FINANCIALS))]
)
#: Where a listing stood: feed's precedence, then page and place.
ORDER = T.StructType([T.StructField("feed", T.StringType()), T.StructField("feed_rank", T.IntegerType()), T.StructField("row_ord", T.LongType())])
