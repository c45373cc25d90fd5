"""Conversion to US dollars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import AMOUNT, RATE

#: A table of rates is broadcast up to this many rows.
MOST_RATES = 10_000


def skips_conversion(amounts: list[str], currency: str = "currency") -> Column:
    """No amount, no currency, or dollars already."""
    none = F.lit(True)
    for a in amounts:
        none = none & F.col(a).isNull()
    return none | F.col(currency).isNull() | (F.col(currency) == "USD")


def converted(amount: Column, rate: Column) -> Column:
    """amount / rate, half-even to two places; rate is foreign units a dollar."""
    return F.bround(amount / F.when(rate != 0, rate), 2)


def to_usd(df: DataFrame, rates: DataFrame, amounts: list[str] = ["last_price", "market_cap"], currency: str = "currency", on_missing_rate: str = "error") -> DataFrame:  # noqa: B006
    """The amounts in dollars. ``rates`` has currency and rate; a join that shuffles nothing large. Two rates of one currency are an error.

    A missing or zero rate: an error when the rows are read, with 'quarantine' a true column ``rate_missing``, with 'null'
    null amounts.
    """
    rate = F.col("rate").cast(RATE)
    twice = F.raise_error(F.concat(F.lit("two rates for "), F.col("currency"))).cast(RATE)
    known = rates.groupBy("currency").agg(F.min(rate).alias("least"), F.max(rate).alias("most"))
    known = known.select(F.col("currency").alias("_currency"), F.when(F.col("least") == F.col("most"), F.col("most")).when(F.col("least").isNotNull(), twice).alias("_rate"))
    few = rates.limit(MOST_RATES + 1).count() <= MOST_RATES  # a table of currencies: the standard has fewer than 200
    out = df.join(F.broadcast(known) if few else known, F.col(currency) == F.col("_currency"), "left")
    skip = skips_conversion(amounts, currency)
    missing = ~skip & (F.col("_rate").isNull() | (F.col("_rate") == 0))
    rate = F.col("_rate")
    if on_missing_rate == "error":
        rate = F.when(missing, F.raise_error(F.concat(F.lit("no rate for "), F.col(currency))).cast(RATE)).otherwise(rate)
    new = {a: F.when(skip, F.col(a)).when(missing & (on_missing_rate == "quarantine"), F.col(a)).otherwise(converted(F.col(a), rate)).cast(AMOUNT) for a in amounts}
    dollars = F.when(skip | (missing & (on_missing_rate == "quarantine")), F.col(currency)).otherwise("USD")
    if on_missing_rate == "quarantine":
        new["rate_missing"] = missing
    return out.withColumns(new | {currency: dollars}).drop("_currency", "_rate")
