"""Identification: the share-class identifier of each listing from a table of responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import is_blank
from .keyed import last_wins


def with_identifier(df: DataFrame) -> DataFrame:
    """id_type and id_value: ISIN, else CUSIP, else the symbol as a ticker."""
    kind = F.when(F.col("isin").isNotNull(), "ID_ISIN").when(F.col("cusip").isNotNull(), "ID_CUSIP").otherwise("TICKER")
    return df.withColumns({"id_type": kind, "id_value": F.coalesce("isin", "cusip", "symbol")})


def _full(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def valid_responses(responses: DataFrame, order: str = "ord") -> DataFrame:
    """id_type, id_value, figi, fig_name, fig_symbol: the last valid answer to each query.

    An answer is valid if its identifier is twelve capitals or digits as it is. Its name is the name, else the security's
    name, else the ticker.
    """
    known = set(responses.columns)
    pick = lambda *names: F.coalesce(*[_full(F.col(n)) for n in names if n in known], F.lit(None).cast("string"))
    ok = responses.filter(F.col("figi").rlike("^[A-Z0-9]{12}$") & F.col("id_value").isNotNull())
    rows = ok.select("id_type", "id_value", "figi", pick("name", "security_name", "ticker").alias("fig_name"), pick("ticker").alias("fig_symbol"), F.col(order).alias("_ord"))
    return last_wins(rows, ["id_type", "id_value"], ["_ord", "figi"]).drop("_ord")


def query_key(entry: dict[str, Column]) -> Column:
    """The number of the query that an answer belongs to: the first numeric of its three spellings."""
    return F.coalesce(*[entry[k].try_cast("int") for k in ("query_number", "queryId", "request_index") if k in entry])


def identify(df: DataFrame, responses: DataFrame, order: str = "ord") -> DataFrame:
    """Listings with share_class_figi; name and symbol are the answer's where it has them. Others are left out."""
    found = valid_responses(responses, order)
    out = with_identifier(df).drop("share_class_figi").join(found, ["id_type", "id_value"])
    return out.withColumns({"share_class_figi": F.col("figi"), "name": F.coalesce("fig_name", "name"), "symbol": F.coalesce("fig_symbol", "symbol")}).drop("figi", "fig_name", "fig_symbol")


def unidentified(df: DataFrame, responses: DataFrame, order: str = "ord") -> DataFrame:
    """The listings that identify() leaves out."""
    return with_identifier(df).join(valid_responses(responses, order).select("id_type", "id_value"), ["id_type", "id_value"], "left_anti")


def needs_figi(figi: Column) -> Column:
    return is_blank(figi)
