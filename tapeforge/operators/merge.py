"""Merging all listings of one security.

Nothing gathers a group's rows: listings become cells (key, field, value, place), which are counted by (key, field, value) first.
Modes and medians are aggregates of these counts; only a key's codes, which are the result, and the distinct spellings of its names are
gathered. So a key with a third of all listings is no task's work, and fields that are null cost nothing. Medians alone are of values
as they are, in one sort, for keys of no more listings than a task may order.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalise import norm_text
from ..functions.similarity import fuzzy_representative
from ..schemas import AMOUNT, AMOUNTS, FIELDS, FUZZY, MODES, field_type
from ..sources.lineage import stored
from . import keyed


def place(df: DataFrame, order: list[str], within: str | None = None) -> Column:
    """Where a row stands, as one value: a number where the order is a feed's and a row's, else a struct; nulls stand first.

    Least numbers are kept by hashing, least structs by sorting all rows. ``within``: a column of places within the row.
    """
    kinds = [type(df.schema[c].dataType) for c in order]
    if len(kinds) != 2 or kinds[0] not in (T.ByteType, T.ShortType, T.IntegerType) or kinds[1] not in (T.ByteType, T.ShortType, T.IntegerType, T.LongType):
        return F.struct(F.struct(*order), within) if within else F.struct(*order)
    whole = lambda c, least: F.coalesce(F.col(c).cast("decimal(20,0)"), F.lit(Decimal(least - 1)))
    # wider than any row's number: the greatest has 38 digits with the place in the row
    at = whole(order[0], -(2**31)) * F.lit(Decimal(2 * 10**19)) + whole(order[1], -(2**63))
    return ((at * F.lit(Decimal(2**31)) + F.col(within)) if within else at).cast("decimal(38,0)")


def cells(df: DataFrame, key: str, order: list[str], fields: list[str], kind) -> DataFrame:
    """key, field, value, ord: a row for each value that isn't null."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast(kind).alias("value")) for f in fields])
    return df.select(key, place(df, order).alias("ord"), F.explode(each).alias("x")).filter("x.value is not null").select(key, "x.*", "ord")


def spellings(df: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """key, field, and the distinct values with their counts in order of first appearance."""
    counts = cells(df, key, order, fields, "string").groupBy(key, "field", "value").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return counts.groupBy(key, "field").agg(F.array_sort(F.collect_list(F.struct("first", "value", "n"))).alias("values"))


def codes(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key and its codes in order of first appearance, without null and blank ones."""
    each = df.select(key, *order, F.posexplode("mics").alias("_at", "code")).filter(F.trim("code") != "")
    firsts = each.groupBy(key, "code").agg(F.min(place(each, order, "_at")).alias("first"))
    return firsts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "code"))), lambda x: x["code"]).alias("codes"))


def leading(values: Column) -> Column:
    """The spelling that stands for those of :func:`spellings`; one alone stands for itself and goes through no Python."""
    several = F.when(F.size(values) > 1, F.transform(values, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"))))
    return F.when(F.size(values) > 1, fuzzy_representative(several)).otherwise(F.get(values, F.lit(0))["value"])


def medians(rows: DataFrame, sizes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, field, value: the exact medians of all amounts. ``sizes``: key and ``n``, its listings."""
    values, by = cells(rows, key, order, list(AMOUNTS), AMOUNT).drop("ord"), [key, "field"]
    large = stored(sizes.filter(F.col("n") > keyed.ORDERED).select(key))
    if large.isEmpty():
        return keyed.median_sorted(values, by, "value")
    large = F.broadcast(large)  # a key for each ORDERED listings at most
    return keyed.median_sorted(values.join(large, key, "left_anti"), by, "value").unionByName(keyed.median_exact(values.join(large, key, "left_semi"), by, "value"))


def merge_listings(df: DataFrame, key: str = "share_class_figi", order: list[str] = ["feed_rank", "row_ord"]) -> DataFrame:  # noqa: B006
    """One row a security with all 37 fields, names normalised again after identification. A group without values has a row too."""
    rows = stored(df.select(*order, *FIELDS).filter(F.col(key).isNotNull()))  # it is read six times
    modes, names = [f for f in MODES if f != key], [f for f in FUZZY if f != key]
    none, text = F.lit(None).cast("array<string>").alias("codes"), F.col("value").cast("string").alias("value")
    most = keyed.mode_first_seen(cells(rows, key, order, modes, "string"), [key, "field"], "value", "ord").select(key, "field", text, none)
    sizes = stored(rows.groupBy(key).agg(F.count("*").alias("n")))
    middle = medians(rows, sizes, key, order)
    middle = middle.select(key, "field", F.col("value").cast(AMOUNT).cast("string").alias("value"), none)
    leaders = spellings(rows, key, order, names).select(key, "field", leading(F.col("values")).alias("value"), none)
    listed = codes(rows, key, order).select(key, F.lit("mics").alias("field"), F.lit(None).cast("string").alias("value"), "codes")
    alone = sizes.select(key, F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), none)
    found = reduce(DataFrame.unionByName, [most, middle, leaders, listed, alone])

    def field(f: str) -> Column:
        if f == "mics":
            return F.max("codes").alias(f)
        return F.max(F.when(F.col("field") == f, F.col("value"))).cast(field_type(f)).alias(f)

    out = found.groupBy(key).agg(*[field(f) for f in FIELDS if f != key])
    return out.withColumns({f: norm_text(F.col(f)) for f in ("name", "symbol")}).select(*FIELDS)
