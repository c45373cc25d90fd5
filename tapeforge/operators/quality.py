"""Validation, quarantine and figures of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..schemas import AMOUNT, AMOUNTS, FIELDS, REQUIRED, UNSIGNED


def checked(field: str, text: Column) -> Column:
    """(value, error) of a field other than an amount, from its normalised text; of mics from the list of them."""
    if field in REQUIRED:
        return N.required_text(field, text)
    if field == "mics":
        return N.mic_codes(text)
    if field == "analyst_rating":
        return F.struct(N.known_rating(text).alias("value"), F.lit(None).cast("string").alias("error"))
    if field == "currency" or field in N.ID_PATTERNS:
        return N.identifier_text(field, text)
    return F.struct(text.alias("value"), F.lit(None).cast("string").alias("error"))


def validate(df: DataFrame, keep: list[str], fields: list[str] = FIELDS) -> DataFrame:
    """All fields normalised, the ``keep`` columns as they are, ``errors``, an array in order of the fields, empty for a valid row, and of
    other rows ``raw``, what they were as JSON.

    Every field is a column of generated code: its text once normalised, then its value and its error. A number in plain form is
    cast; only texts that a cast refuses go, all of a row in one array, through the parser of other forms, whose steps are thus
    compiled once and run for rows that need them.
    """
    amounts, plain = [f for f in fields if f in AMOUNTS], [f for f in fields if f not in AMOUNTS and f != "mics"]
    text = {f: F.col(f).cast("string") for f in amounts}
    first = df.select(
        *keep, *[F.transform("mics", N.norm_text).alias("_mics")] * ("mics" in fields), F.struct(*fields).alias("_raw"),
        *[N.norm_text(F.col(f).cast("string")).alias(f"_{f}") for f in plain],
        *[text[f].alias(f"_{f}") for f in amounts], *[text[f].try_cast(AMOUNT).alias(f"_plain_{f}") for f in amounts],
    )
    odd = {f: F.col(f"_{f}").isNotNull() & (F.col(f"_plain_{f}").isNull() | ((F.col(f"_plain_{f}") < 0) & F.lit(f in UNSIGNED))) for f in amounts}
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.when(odd[f], F.col(f"_{f}")).alias("text"), F.lit(f in UNSIGNED).alias("unsigned")) for f in amounts])
    if amounts:
        first = first.withColumn("_odd", F.when(reduce(lambda x, y: x | y, odd.values()), N.decimals(cells)))
    number = {f: F.get("_odd", F.lit(i)) for i, f in enumerate(amounts)}
    pairs = {f: checked(f, F.col(f"_{f}")) for f in fields if f not in AMOUNTS}
    values = {f: p["value"] for f, p in pairs.items()} | {f: F.when(odd[f], number[f]["value"]).otherwise(F.col(f"_plain_{f}")) for f in amounts}
    errors = {f: p["error"] for f, p in pairs.items()} | {f: number[f]["error"] for f in amounts}
    out = first.select(*keep, *[values[f].alias(f) for f in fields], *[errors[f].alias(f"_error_{f}") for f in fields], "_raw")
    found = [F.col(f"_error_{f}") for f in fields]
    bad = F.coalesce(*found).isNotNull()
    none = F.array().cast("array<string>")
    return out.select(*keep, *fields, F.when(bad, F.array_compact(F.array(*found))).otherwise(none).alias("errors"), F.when(bad, F.to_json("_raw")).alias("raw"))


def _n_errors() -> Column:
    """How many errors a row has. The task's number, which changes nothing, keeps Spark from moving a filter on it below the
    validation, where all that the errors are made of would be computed, and compiled, once more."""
    return F.size("errors") + F.lit(0) * F.spark_partition_id()


def valid(df: DataFrame) -> DataFrame:
    return df.filter(_n_errors() == 0).drop("errors", "raw")


def rejected(df: DataFrame, keep: list[str]) -> DataFrame:
    """The quarantine: where each row stood, why, and what it was."""
    return df.filter(_n_errors() > 0).select(*keep, "errors", "raw")


def feed_quality(df: DataFrame, feed: str = "feed", key: str = "isin", needed: list[str] = ["isin", "name", "currency"]) -> DataFrame:  # noqa: B006
    """A row a feed: rows, missing values, and whether keys are there and unique."""
    missing = [F.count_if(N.is_blank(F.col(c))).alias(f"missing_{c}") for c in needed]
    out = df.groupBy(feed).agg(F.count("*").alias("n_rows"), *missing, F.count_distinct(F.when(~N.is_blank(F.col(key)), F.col(key))).alias("n_keys"))
    return out.withColumn("passed", (F.col("n_rows") > 0) & (F.col(f"missing_{key}") == 0) & (F.col("n_keys") == F.col("n_rows")))


def run_metrics(stages: dict[str, DataFrame], key: str = "share_class_figi") -> DataFrame:
    """A row a stage: rows, distinct keys and duplicates."""
    out = None
    for stage, df in stages.items():
        own = df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).select(F.lit(stage).alias("stage"), "n_rows", "n_keys")
        out = own if out is None else out.unionByName(own)
    return out.withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))
