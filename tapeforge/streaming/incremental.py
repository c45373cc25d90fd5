"""The jobs on streams of new feed files.

Parsing, conversion and identification have no state. What earlier batches left is in tables of buckets by key, of which a batch reads
those that its own keys fall into; only securities that a batch touches are merged again. A batch that runs twice leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..operators import canonical, merge
from ..operators.keyed import first_wins
from ..plans.jobs import PLACE, listings
from ..schemas import FIELDS
from ..sources import buckets, store
from ..sources.lineage import stored

SEEN = ["feed", "feed_key"]


def listing_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New files of raw listings in the common layout, JSON lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def identified_stream(raw: DataFrame, rates: DataFrame, responses: DataFrame) -> DataFrame:
    """Stateless: parse, convert and identify by joins with tables."""
    return listings(raw, rates, responses, on_missing_rate="quarantine")


def new_only(batch: DataFrame, seen: DataFrame | None, keys: list[str] = SEEN, order: str = "row_ord") -> DataFrame:
    """The first row of each key of a batch that no earlier batch had."""
    first = first_wins(batch, keys, order)
    if seen is None:
        return first
    match = [first[k].eqNullSafe(seen[k]) for k in keys]
    return first.join(seen.select(*keys).distinct(), match, "left_anti")


def upsert_batch(table: str, listings_path: str, n_buckets: int = buckets.BUCKETS):
    """A function for foreachBatch: adds the batch's listings, merges the securities touched, publishes them.

    Both tables are in buckets by security: of either only the buckets of the batch's securities are read, listings are added in
    files of their own, and the published table has those buckets rewritten. A batch that runs again adds nothing.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stored(batch.select(*PLACE, *FIELDS).filter("share_class_figi is not null"))
        if rows.isEmpty():
            return
        key = ["share_class_figi"]
        buckets.change(rows, listings_path, key, None, n_buckets, "stream", batch_id)
        touched = rows.select(*key).distinct()
        everything = buckets.read_of_keys(spark, listings_path, touched)
        merged = merge.merge_listings(everything.join(touched, key, "left_semi"))
        store.upsert_canonical(canonical.canonicalise(merged), table, n_buckets=n_buckets)

    return run


def upsert_stream(identified: DataFrame, table: str, listings_path: str, checkpoint: str) -> DataStreamWriter:
    """Start it with .start(); all files there are one run with .trigger(availableNow=True)."""
    return identified.writeStream.foreachBatch(upsert_batch(table, listings_path)).option("checkpointLocation", checkpoint)


def running_first(path: str, keys: list[str] = SEEN, order: str = "row_ord", n_buckets: int = buckets.BUCKETS):
    """A function for foreachBatch: adds the rows whose key no earlier batch had to the table of buckets at ``path``.

    A batch reads the keys of the buckets that its own keys fall into, and writes new rows only.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        first = stored(first_wins(batch, keys, order))
        seen = buckets.read_of_keys(batch.sparkSession, path, first)
        buckets.change(new_only(first, seen, keys, order), path, keys, None, n_buckets, "stream", batch_id)

    return run
