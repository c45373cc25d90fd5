"""The published form: one nested record a security, and its JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import is_blank
from ..schemas import AMOUNTS, CANONICAL, FINANCIALS, IDENTITY


def canonicalise(df: DataFrame, on_invalid: str = "error") -> DataFrame:
    """identity and financials; a missing or blank share_class_figi is an error, or with 'quarantine' left out."""
    figi = F.col("share_class_figi")
    if on_invalid == "quarantine":
        df = df.filter(~is_blank(figi))
    else:
        figi = F.when(is_blank(figi), F.raise_error(F.lit("share_class_figi is missing")).cast("string")).otherwise(figi)
    own = df.withColumn("share_class_figi", figi)
    return own.select(F.struct(*IDENTITY).alias("identity"), F.struct(*FINANCIALS).alias("financials"))


def plain_number(value: Column) -> Column:
    """A decimal's shortest text."""
    text = value.cast("string")
    text = F.when(text.contains("E"), F.format_string("%.14f", value.cast("double"))).otherwise(text)
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def to_json(identity: Column, financials: Column) -> Column:
    """The record's JSON: nulls are kept, numbers are texts, fields in their order."""
    finance = F.struct(*[(plain_number(financials[f]) if f in AMOUNTS else financials[f]).alias(f) for f in FINANCIALS])
    return F.to_json(F.struct(identity.alias("identity"), finance.alias("financials")), {"ignoreNullFields": "false"})


def from_json(payload: Column) -> Column:
    """A struct of identity and financials from the JSON; null where it is broken."""
    texts = CANONICAL.simpleString().replace("decimal(32,14)", "string")
    raw = F.from_json(payload, texts)
    finance = F.struct(*[(raw["financials"][f].try_cast("decimal(32,14)") if f in AMOUNTS else raw["financials"][f]).alias(f) for f in FINANCIALS])
    return F.struct(raw["identity"].alias("identity"), finance.alias("financials"))
