"""The published table and its files: versions in buckets by key, sorted JSON lines, lookups and snapshots.

The table is one of :mod:`buckets`: an upsert rewrites the buckets that hold its keys, a lookup reads those, and a version holds
from the moment that its manifest has its number, whoever else writes meanwhile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalise import is_blank
from ..operators.canonical import from_json, to_json
from ..operators.keyed import last_wins
from . import buckets

KEY = "identity.share_class_figi"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, oldest first."""
    return buckets.versions(spark, path)


def current(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version, if there is one."""
    return (versions(spark, path) or [None])[-1]


def publish(df: DataFrame, path: str, n_buckets: int = buckets.BUCKETS) -> None:
    """The whole table anew, of one row a key."""
    buckets.replace(df, path, [KEY], n_buckets)


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    buckets.prune(spark, path, keep)


def merged(existing: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """existing with the rows of new in place of those with their keys; of equal keys in new the last."""
    if order:
        new = last_wins(new, key, order).drop(order)
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def one_a_key(new: DataFrame, order: str | list[str] | None = None) -> DataFrame:
    """identity and financials: of repeated keys the last by ``order``, and of equals, or without an order, that of the greatest JSON."""
    places = [order] if isinstance(order, str) else list(order or [])
    place = F.struct(*places, to_json(F.col("identity"), F.col("financials")).alias("_text"))
    new = new.repartition(F.col(KEY), *places)  # the aggregate sorts whole records: no task gets those of all that it reads
    return new.groupBy(F.col(KEY).alias("_key")).agg(F.max_by(F.struct("identity", "financials"), place).alias("_row")).select("_row.identity", "_row.financials")


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with the rows of new in place of those with their keys, one row a key in each."""
    return old.join(new.select(F.col(KEY).alias("_key")), F.col(KEY) == F.col("_key"), "left_anti").unionByName(new)


def upsert_canonical(new: DataFrame, path: str, order: str | list[str] | None = None, n_buckets: int = buckets.BUCKETS) -> list[int]:
    """Insert or replace by share_class_figi, the last of repeated keys by ``order``; returns the buckets that were rewritten."""
    return buckets.change(one_a_key(new, order), path, [KEY], replaced, n_buckets)


def load_canonical(spark: SparkSession, path: str) -> DataFrame:
    """All records in order of their key; LookupError where nothing has been published."""
    found = buckets.read(spark, path)
    if found is None:
        raise LookupError(f"no table has been published at {path}")
    return found.filter("identity is not null").orderBy(KEY)


def lookup_canonical(df: DataFrame, figi: str) -> DataFrame:
    """The record of exactly this identifier: none or one row."""
    return df.filter((F.col(KEY) == figi) & F.col("identity").isNotNull()).limit(1)


def get_canonical(spark: SparkSession, path: str, figi: str):
    """The record as a row, or LookupError; one bucket is read."""
    found = buckets.manifest(spark, path)
    if found is None:
        raise LookupError(f"no table has been published at {path}")
    at = spark.range(1).select(buckets.bucket_of([F.lit(figi)], found.buckets)).first()[0]
    rows = lookup_canonical(buckets.read(spark, path, [at], found.number), figi).collect()
    if not rows:
        raise LookupError(f"no security {figi}")
    return rows[0]


def lookup_many(df: DataFrame, keys: DataFrame, column: str = "figi") -> DataFrame:
    return df.join(keys.select(F.col(column).alias("_key")).distinct(), F.col(KEY) == F.col("_key"), "left_semi")


def payloads(df: DataFrame) -> DataFrame:
    """share_class_figi, payload: the record's JSON."""
    return df.select(F.col(KEY).alias("share_class_figi"), to_json(F.col("identity"), F.col("financials")).alias("payload"))


def export_ndjson(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Gzipped JSON lines in order of key; many files unless a single one is asked for."""
    rows = payloads(df).orderBy("share_class_figi").select("payload")
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("compression", "gzip").text(path)


def parse_ndjson(lines: DataFrame) -> DataFrame:
    """Records of JSON lines in a column value: blank lines are skipped, of equal keys the last line holds.

    The order is that of a column ``ord``, else of files by name, parts of a file by where they begin, and lines as a task reads them.
    Lines are dealt out before they are parsed: the aggregate sorts whole records, which are no one part of a file's to hold.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")) if "ord" not in lines.columns else F.col("ord")
    rows = lines.select(place.alias("ord"), F.trim("value").alias("value")).filter("value <> ''")
    rows = rows.repartition("ord", "value").select("ord", from_json(F.col("value")).alias("r"))
    key = F.col("r.identity.share_class_figi")
    bad = F.when(is_blank(key), F.raise_error(F.lit("a line has no share_class_figi")).cast("string")).otherwise(key)
    return last_wins(rows.withColumn("k", bad), "k", "ord").select("r.identity", "r.financials")


def rebuild_from_ndjson(spark: SparkSession, files: str, path: str) -> None:
    """The table anew from exported files."""
    publish(parse_ndjson(spark.read.text(files)), path)


def fresh(df: DataFrame, now: Column, ttl_minutes: int = 1440, fetched_at: str = "fetched_at", keys: list[str] | None = None) -> DataFrame:
    """Entries not older than ttl_minutes, 0 for no limit; with keys only the newest of each."""
    if ttl_minutes < 0:
        raise ValueError("ttl_minutes is negative")
    if keys:
        df = last_wins(df, keys, fetched_at)
    return df if ttl_minutes == 0 else df.filter(now - F.col(fetched_at) <= 60 * ttl_minutes)
