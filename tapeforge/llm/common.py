"""What the operators share: reading, cutting lineage, and words and hashes of Arrow batches."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that a task works on at once; longer texts make a chunk of their own.
CHUNK_BYTES = 1 << 18


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or one in the warehouse where none is set."""
    sc = spark.sparkContext
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def stored(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64), data[offsets[0] : offsets[-1]] if len(offsets) else data


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)


#: The ASCII white space that separates words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value a byte, the same for A-Z and a-z; which bytes separate words; and the powers' base."""
    rng = np.random.Generator(np.random.PCG64(20240611))
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lowered = values.copy()
    lowered[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    return values, lowered, space


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers and their inverses modulo 2**64."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def words(offsets: np.ndarray, data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts: (64-bit hash of each, first byte, end, first word of each text with the total last).

    A word is a run of bytes that are not ASCII white space; with ``lower`` A-Z counts as a-z.
    """
    values, lowered, space = _tables()
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(space[data], out=inside[1:-1])
    begin = inside[1:-1] & ~inside[:-2]
    finish = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    begin[cuts] = inside[1:-1][cuts]  # words end where a text ends
    finish[cuts - 1] = inside[1:-1][cuts - 1]
    first, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    powers, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((lowered if lower else values)[data] * powers[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[first]) * inverse[first])
    return hashes, first, end, np.searchsorted(first, offsets)
