"""Aggregates by key whose answer depends on the order of rows, with that order as a column.

All of them aggregate before they shuffle; a key that holds a large part of all rows is counted by (key, value)
first, so that no task sees all of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lineage import stored


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def mode_first_seen(df: DataFrame, keys: str | list[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """The most frequent value by key; of equally frequent ones that seen first. Nulls don't count."""
    keys = _keys(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    # the greatest count, then the least order: max_by needs one ordering, so the order is negated by position
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("first")))
    return counts.groupBy(*keys).agg(best.alias(out or value))


#: Distinct values of a key that one task orders, and the parts that the range of a key with more is cut into each round.
ORDERED, PARTS = 1 << 16, 1 << 10


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_of_{k}"]) for k in keys])


def _within(counts: DataFrame, targets: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The counted values in the range of each target of their key."""
    named = targets.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_rank", "_before", "_low", "_high")
    return counts.join(named, _same(counts, named, keys) & counts[value].between(named["_low"], named["_high"]))


def narrowed(counts: DataFrame, hot: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, _rank, _before, _low, _high, _values: for both middle ranks of each key the range of at most ORDERED values that holds it.

    A round cuts each range into PARTS of equal width, counts them, and keeps the part with the rank, so a range of 2 ** 107 steps, the
    widest that amounts have, is down to one in eleven rounds. Counts are summed before they are shuffled, and no task sees a key whole.
    """
    ranks = F.explode(F.array_distinct(F.array(F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)))).alias("_rank")
    targets = stored(hot.select(*keys, ranks, F.lit(0).cast("long").alias("_before"), "_low", "_high", "_values"))
    while (targets.agg(F.max("_values")).first()[0] or 0) > ORDERED:
        wide = F.nullif((F.col("_high") - F.col("_low")).cast("double"), F.lit(0.0))
        part = F.floor(F.coalesce((F.col(value) - F.col("_low")).cast("double") / wide * PARTS, F.lit(0.0))).alias("_part")
        own = _within(counts, targets, keys, value).groupBy(*keys, "_rank", part).agg(F.first("_before").alias("_before"), F.sum("_n").alias("_n"), F.count("*").alias("_values"), F.min(value).alias("_low"), F.max(value).alias("_high"))
        seen = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))  # over PARTS rows
        found = own.withColumn("_seen", F.col("_before") + seen).filter((F.col("_seen") > F.col("_rank")) & (F.col("_seen") - F.col("_n") <= F.col("_rank")))
        targets = stored(found.select(*keys, "_rank", (F.col("_seen") - F.col("_n")).alias("_before"), "_low", "_high", "_values"))
    return targets


def median_sorted(df: DataFrame, keys: str | list[str], value: str, out: str | None = None) -> DataFrame:
    """The same as :func:`median_exact` for keys of at most ORDERED rows, whose values a task orders as they are: one shuffle."""
    w = Window.partitionBy(*_keys(keys))
    ranked = df.filter(F.col(value).isNotNull()).select(*_keys(keys), value).withColumn("_at", F.row_number().over(w.orderBy(value))).withColumn("_all", F.count("*").over(w))
    middle = ranked.filter((F.col("_at") == F.floor((F.col("_all") + 1) / 2)) | (F.col("_at") == F.floor(F.col("_all") / 2) + 1))
    return middle.groupBy(*_keys(keys)).agg(((F.min(value) + F.max(value)) / 2).alias(out or value))


def median_exact(df: DataFrame, keys: str | list[str], value: str, out: str | None = None) -> DataFrame:
    """The exact decimal median by key; of an even number the mean of the middle two. Nulls don't count.

    Values are counted by (key, value); running counts say which distinct values stand in the middle. A key with more than ORDERED
    distinct values is narrowed down by counts of parts of its range first.
    """
    keys = _keys(keys)
    counts = stored(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_all"), F.count("*").alias("_values"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    hot = stored(totals.filter(F.col("_values") > ORDERED))
    w = Window.partitionBy(*keys)
    seen = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    few, many = counts, not hot.isEmpty()
    if many:
        named = hot.select(*[F.col(k).alias(f"_of_{k}") for k in keys])
        few = counts.join(named, _same(counts, named, keys), "left_anti")
    ranked = few.withColumn("_seen", seen).withColumn("_all", F.sum("_n").over(w))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = ranked.filter((F.col("_seen") > low) & (F.col("_seen") - F.col("_n") <= high)).select(*keys, value)
    if many:
        left = _within(counts, narrowed(counts, hot, keys, value), keys, value)
        seen = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        found = left.withColumn("_seen", seen).filter((F.col("_seen") > F.col("_rank")) & (F.col("_seen") - F.col("_n") <= F.col("_rank")))
        middle = middle.unionByName(found.select(*keys, value))
    return middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(out or value))


def ordered_union(df: DataFrame, keys: str | list[str], items: str, order: str, out: str | None = None) -> DataFrame:
    """The distinct items of all lists by key in order of first appearance, without null and blank ones; null if none."""
    keys = _keys(keys)
    each = df.select(*keys, order, F.posexplode(items).alias("_at", "_item"))
    each = each.filter(F.trim("_item") != "").groupBy(*keys, "_item").agg(F.min(F.struct(order, "_at")).alias("_first"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_first", "_item"))), lambda x: x["_item"])
    found = each.groupBy(*keys).agg(listed.alias(out or items))
    return df.select(*keys).distinct().join(found, keys, "left")


def _pick(df: DataFrame, keys: list[str], order: str | list[str], last: bool, null_key: str) -> DataFrame:
    own = [F.col(c) for c in _keys(order)]
    row = F.struct(*[F.col(c) for c in df.columns])
    chosen = (F.max_by if last else F.min_by)(row, F.struct(*own))
    whole = df if null_key == "collapse" else df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    out = whole.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(chosen.alias("_row")).select("_row.*")
    if null_key == "keep":
        out = out.unionByName(df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])))
    return out


def first_wins(df: DataFrame, keys: str | list[str], order: str | list[str], null_key: str = "collapse") -> DataFrame:
    """The first row of each key. Null keys are one key, or are all kept with ``null_key='keep'``.

    An aggregate, not a window: each task keeps one row a key, so the null key costs nothing.
    """
    return _pick(df, _keys(keys), order, False, null_key)


def last_wins(df: DataFrame, keys: str | list[str], order: str | list[str], null_key: str = "collapse") -> DataFrame:
    """The last row of each key."""
    return _pick(df, _keys(keys), order, True, null_key)


def one_key(df: DataFrame, group: str | list[str], key: str) -> DataFrame:
    """df, or an error at run time where a group has no key or more than one."""
    bad = df.groupBy(*_keys(group)).agg(F.count_distinct(key).alias("n")).filter("n <> 1").agg(F.count("*").alias("n"))
    check = F.when(F.col("_bad") > 0, F.raise_error(F.concat(F.lit("groups without exactly one key: "), F.col("_bad").cast("string")))).otherwise(F.lit(True))
    return df.crossJoin(F.broadcast(bad.withColumnRenamed("n", "_bad"))).filter(check).drop("_bad")  # a single row is joined
