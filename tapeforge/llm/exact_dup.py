"""Exact duplicates by an extendible-hash index on shared files, with DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z. The index is made of the distinct hashes of the texts, so that a
group of copies of any size is one key, counted before anything is shuffled:

* ``keys``: a hash, its number of rows and its bucket. A bucket is a prefix of the hash. One that holds more than ``capacity``
  keys splits in two by its next bit, and the directory doubles where that takes a bit more than it has. Counts by prefix say
  where this ends: ``STEP`` bits at a time, and only the keys of overfull buckets are counted again.
* ``directory``: a row for each slot, the bucket that it points to and that bucket's own depth. The slots are joined.
* ``links``: hashes with two rows or more are chains. Their texts, and no others, are read again and compared byte by byte (grouped
  by the whole text, with copies counted before the shuffle); different texts with one hash are links of its chain.

Owner tasks each hold a range of whole buckets, in order of their hashes, as one file of ``keys`` and of ``links``; they chain the
links. Rows are joined with links of at least two rows, by hash and SHA-256.

Defined results: a null text is empty, and empty texts are equal; of rows with one doc_id and equal texts, one stays; a null
doc_id is less than all others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, stored

#: Keys that a bucket holds, and the bits by which overfull buckets are counted again.
CAPACITY, STEP = 1 << 14, 12
LOWER = "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Index:
    """The tables of an index, all in one shared folder."""

    path: str
    keys: DataFrame
    directory: DataFrame
    links: DataFrame


def normalised(text: Column) -> Column:
    """A-Z as a-z; the faster function lowers other letters too, so it takes texts of ASCII only."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, LOWER.upper(), LOWER))


def hashed(text: Column, bits: int = 64) -> Column:
    """The hash of a normalised text; fewer bits than 64, the upper ones, are for tests of collisions."""
    h = F.xxhash64(text)
    return h if bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - bits), 64 - bits)


def _right(number: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", number, bits.cast("int"))


def _left(number: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", number, bits.cast("int"))


def _prefix(key: Column, depth: int) -> Column:
    """The upper ``depth`` bits of a hash, as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def buckets(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """depth, bucket, n: the prefixes at which no bucket holds more than ``capacity`` of the distinct ``hash`` of keys."""
    done, open_keys, depth = None, keys.select("hash"), 0
    while True:
        deeper = min(64, depth + STEP)
        fine = stored(open_keys.groupBy(_prefix(F.col("hash"), deeper).alias("fine")).agg(F.count("*").alias("n")))
        # what a bucket would hold at each depth down to the finest one: the first depth that isn't overfull is its own
        cells = fine.select("fine", "n", F.explode(F.sequence(F.lit(depth), F.lit(deeper))).alias("depth"))
        cells = cells.withColumn("bucket", _right(F.col("fine"), F.lit(deeper) - F.col("depth")))
        held = cells.withColumn("held", F.sum("n").over(Window.partitionBy("depth", "bucket")))  # at most 2 ** STEP rows
        own = held.filter((F.col("held") <= capacity) | (F.col("depth") == 64)).groupBy("fine").agg(F.min(F.struct("depth", "bucket")).alias("b"), F.first("n").alias("n"))
        found = own.groupBy("b.depth", "b.bucket").agg(F.sum("n").alias("n"))
        done = stored(found if done is None else done.unionByName(found))
        over = fine.filter(F.col("n") > capacity).select("fine")
        if deeper == 64 or over.isEmpty():
            return done
        open_keys = open_keys.join(over, _prefix(F.col("hash"), deeper) == F.col("fine"), "left_semi")
        depth = deeper


def slots(found: DataFrame) -> tuple[DataFrame, int]:
    """(slot, depth, bucket, place of a directory as deep as its deepest bucket; that depth). A bucket's place is its first slot."""
    top = found.agg(F.max("depth")).first()[0] or 0
    more = F.lit(top) - F.col("depth")
    first, width = _left(F.col("bucket"), more), _left(F.lit(1).cast("long"), more)
    return found.select(F.explode(F.sequence(first, first + width - 1)).alias("slot"), "depth", "bucket", first.alias("place")), top


def build(docs: DataFrame, rows: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> Index:
    """The index of ``docs``, whose rows' doc_id, hash and SHA-256 are ``rows``."""
    spark, path = docs.sparkSession, f"{shared_dir(docs.sparkSession).rstrip('/')}/index-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    def owned(df: DataFrame) -> DataFrame:
        """Each task, and file, has a range of whole buckets in order of their hashes."""
        return df.repartitionByRange("place").sortWithinPartitions("place", "hash")

    counts = stored(rows.groupBy("hash").agg(F.count("*").alias("n_rows")))
    found, depth = slots(buckets(counts, capacity))
    directory = kept(found, "directory")
    keys = kept(owned(counts.join(directory, _prefix(F.col("hash"), depth) == F.col("slot")).select("hash", "n_rows", "depth", "bucket", "place")), "keys")
    chains = keys.filter("n_rows > 1").select("hash", "place")
    wanted = rows.join(chains, "hash", "left_semi").select("doc_id").distinct()
    wanted = wanted.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"))
    doc = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    doc = doc.join(wanted, (F.coalesce("doc_id", F.lit(0)) == F.col("_id")) & (F.col("doc_id").isNull() == F.col("_none")), "left_semi")
    texts = doc.select("doc_id", normalised(F.col("text")).alias("text"))
    same = texts.groupBy(hashed(F.col("text"), bits).alias("hash"), "text").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    same = same.select("hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), "group_size", "keep_id").join(chains, "hash")
    chained = owned(same).withColumn("link", F.row_number().over(Window.partitionBy("place", "hash").orderBy("sha")))
    return Index(path, keys, directory, kept(chained, "links"))


def digests(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, hash and SHA-256 of every row's text, written once."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    return stored(text.select("doc_id", hashed(F.col("text"), bits).alias("hash"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")))


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = digests(docs, bits)
    links = build(docs, rows, capacity, bits).links.filter("group_size > 1").select("hash", "sha", "group_size", "keep_id")
    # a row and its exact repeats are one here, and each is a row again below
    own = rows.groupBy("hash", "sha", "doc_id").agg(F.count("*").alias("times"))
    out = own.join(links, ["hash", "sha"], "left")
    out = out.select("doc_id", "sha", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
