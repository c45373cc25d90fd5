"""Document fingerprints by improbable features.

Byte windows are ranked by how rare their entropy is over the whole corpus. In every run of
``POPULARITY`` windows the rarest gets a point; windows with ``POINTS`` points, and the rarest of
the text, are its features (short texts have those of a shorter window as well). They go, in order of position, into chained Bloom filters of
``FILTER_BITS`` bits with ``PER_FILTER`` features at most. Two fingerprints are compared by the bits
that their filters share, less the bits shared by chance.

Defined results: a null text counts as empty and has an empty fingerprint; two equal fingerprints have
likeness 1, an empty and another one 0. Rows with an equal or null id are ordered by their text, null
ids first. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix, stored, text_bytes

WINDOW = 32
#: Texts of fewer bytes also give features of the short window.
SHORT_TEXT, SHORT_WINDOW = 256, 8
#: Run length and least points, for either window.
POPULARITY, POINTS = {32: 32, 8: 4}, {32: 12, 8: 1}
FILTER_BITS, PER_FILTER, HASHES = 2048, 160, 5
#: Entropy is sorted into bins of a thousandth of its maximum; below the tenth a window is never a feature.
BINS, WEAK = 1001, 100
_NEVER = np.int64(1 << 20)  # a rank after all others
_NO_KEY = np.int64(1 << 60)
_SCALE = 1 << 12


def _bins(data: np.ndarray, w: int) -> np.ndarray:
    """The entropy bin of the window that starts at each byte."""
    n = len(data) - w + 1
    ahead = np.ones(len(data), np.uint8)  # the same byte from here to w - 1 further on
    behind = np.ones(len(data), np.uint8)
    for d in range(1, w):
        same = (data[d:] == data[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    terms, step, bin_of = _entropy_tables(w)
    total = np.empty(n, np.int32)
    total[0] = terms[np.unique(data[:w], return_counts=True)[1]].sum()
    np.subtract(step[behind[w:]], step[ahead[: n - 1]], out=total[1:])
    np.cumsum(total, out=total)
    return bin_of[total]


@functools.cache
def _entropy_tables(w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c * log2(c) for each count c of a byte, in whole units; its steps; and the bin of each sum of them."""
    counts = np.arange(1, w + 1)
    terms = np.zeros(w + 1, np.int32)
    terms[1:] = np.rint(counts * np.log2(counts) * _SCALE).astype(np.int32)
    step = np.zeros(w + 1, np.int32)
    step[1:] = terms[1:] - terms[:-1]
    most = int(terms[w])
    return terms, step, ((most - np.arange(most + 1)) * (BINS - 1) // most).astype(np.int16)


def _inside(offsets: np.ndarray, n: int, w: int) -> np.ndarray:
    """Which windows lie within one text."""
    size = np.diff(offsets)
    ok = np.zeros(n + 1, np.int8)
    has = size >= w
    np.add.at(ok, offsets[:-1][has], 1)
    np.add.at(ok, offsets[1:][has] - w + 1, -1)
    return np.cumsum(ok[:n]).astype(bool)


def entropy_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows have each entropy bin, over all texts and, for the short window, all short texts: 2 x BINS values."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(2 * BINS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                offsets, data = text_bytes(part.column("text"))
                size = np.diff(offsets)
                brief = np.repeat(size < SHORT_TEXT, size)
                for k, (w, own, at) in enumerate(((WINDOW, data, offsets), (SHORT_WINDOW, data[brief], np.append(0, np.cumsum(size[size < SHORT_TEXT]))))):
                    if len(own) >= w:
                        ok = _inside(at, len(own) - w + 1, w)
                        found[k * BINS : (k + 1) * BINS] += np.bincount(_bins(own, w)[ok], minlength=BINS)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["bin", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(2 * BINS, np.int64)
    for r in rows:
        out[r["bin"]] = r["n"]
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Ranks from bin counts, 0 for the rarest bin that occurs; weak bins get none."""
    ranks = np.full((2, BINS), _NEVER)
    for k in range(2):
        own = counts[k * BINS : (k + 1) * BINS]
        order = np.lexsort((np.arange(BINS), own))
        order = order[order >= WEAK]
        ranks[k, order] = np.arange(len(order))
    return ranks


def _features(offsets: np.ndarray, data: np.ndarray, w: int, ranks: np.ndarray) -> np.ndarray:
    """First bytes of the selected windows, ascending."""
    n = len(data) - w + 1
    if n < 1:
        return np.empty(0, np.int64)
    ok = _inside(offsets, n, w)
    if not ok.any():
        return np.empty(0, np.int64)
    key = (ranks[_bins(data, w)] << np.int64(32)) | np.arange(n)
    key[~ok] = _NO_KEY
    size = np.diff(offsets)
    start, last = offsets[:-1][size >= w], offsets[1:][size >= w] - w
    bounds = np.minimum(np.column_stack([start, last + 1]).ravel(), n)
    # a text's rarest window is always a feature; reduceat's odd segments lie between texts
    best = np.minimum.reduceat(np.append(key, _NO_KEY), bounds)[::2]
    # below, the rarest in each run of POPULARITY windows, by doubling
    low, reach = key, 1
    while reach < POPULARITY[w]:
        shift = min(reach, POPULARITY[w] - reach)
        if len(low) <= shift:
            low = low[:0]
            break
        low = np.minimum(low[:-shift], low[shift:])
        reach += shift
    points = np.zeros(n, np.int64)
    if len(low):
        whole = _inside(offsets, len(low), w + POPULARITY[w] - 1)
        won = low[whole]
        won = won[won < _NO_KEY]
        points = np.bincount(won & np.int64(0xFFFFFFFF), minlength=n)
    chosen = points >= POINTS[w]
    best = best[best < _NO_KEY]
    chosen[best & np.int64(0xFFFFFFFF)] = True
    chosen &= key < (_NEVER << np.int64(32))
    return np.flatnonzero(chosen & ok)


def _hashes(data: np.ndarray, at: np.ndarray, w: int) -> np.ndarray:
    """A 64-bit hash of each window."""
    rows = np.ascontiguousarray(data[at[:, None] + np.arange(w)]).view(np.uint64)
    h = np.full(len(at), w, np.uint64)
    for k in range(rows.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The Bloom filters of each text: an array of FILTER_BITS // 8 bytes a filter."""
    size = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = _features(offsets, data, WINDOW, ranks[0])
    owner = np.searchsorted(offsets, at, side="right") - 1
    owners, hashes, place = [owner], [_hashes(data, at, WINDOW)], [at]
    short = np.flatnonzero((size < SHORT_TEXT) & (size > 0))
    if len(short):
        small = np.frombuffer(b"".join(texts[i] for i in short), np.uint8)
        bounds = np.concatenate([[0], np.cumsum(size[short])])
        at = _features(bounds, small, SHORT_WINDOW, ranks[1])
        owner = short[np.searchsorted(bounds, at, side="right") - 1]
        owners.append(owner)
        hashes.append(_hashes(small, at, SHORT_WINDOW))
        place.append(at)
    owner, h, at = np.concatenate(owners), np.concatenate(hashes), np.concatenate(place)
    bare = np.setdiff1d(np.flatnonzero(size > 0), owner)  # no window in it: the whole text is the feature
    if len(bare):
        own = [int.from_bytes(hashlib.sha256(texts[i]).digest()[:8], "little") for i in bare]
        owner, h, at = np.append(owner, bare), np.append(h, np.array(own, np.uint64)), np.append(at, np.zeros(len(bare), np.int64))
    order = np.lexsort((at, owner))
    owner, h = owner[order], h[order]
    once = np.sort(np.unique(mix(h ^ mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)[1])  # a feature counts once a text
    owner, h = owner[once], h[once]
    begin = np.searchsorted(owner, np.arange(len(texts)))
    count = np.diff(np.append(begin, len(owner)))
    filters = -(-count // PER_FILTER)
    base = np.concatenate([[0], np.cumsum(filters)])
    row = base[owner] + (np.arange(len(owner)) - begin[owner]) // PER_FILTER
    bits = np.zeros((base[-1], FILTER_BITS), bool)
    for k in range(HASHES):
        bits[row, (h >> np.uint64(11 * k)) % np.uint64(FILTER_BITS)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[base[i] : base[i + 1]] for i in range(len(texts))]


def encode(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: how far the smaller chain's filters overlap the best filters of the other, beyond chance."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    x, y = (a, b) if (len(a), a.tobytes()) <= (len(b), b.tobytes()) else (b, a)
    x, y = np.ascontiguousarray(x).view(np.uint64), np.ascontiguousarray(y).view(np.uint64)
    nx, ny = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    if len(x) == len(y) == 1:
        shared, n, m = int(np.bitwise_count(x & y).sum()), int(nx[0]), int(ny[0])
        chance = n * m / FILTER_BITS
        return min(1.0, max(0.0, (shared - chance) / max(min(n, m) - chance, 1e-9)))
    total = 0.0
    for row, n in zip(x, nx, strict=True):
        shared = np.bitwise_count(y & row).sum(1, dtype=np.int64)
        chance, most = n * ny / FILTER_BITS, np.minimum(n, ny)
        total += n * float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / float(nx.sum())


_LEAST = -(1 << 63)
#: Rows of a range, about; and how many quantiles of the ids are taken, each cut into equal ranges.
RANGE_ROWS, QUANTILES = 20_000, 500


def in_order(docs: DataFrame) -> DataFrame:
    """All rows dealt into ranges of ascending id, sorted, each range followed by the first row of the next.

    Columns: part, follower (the row belongs to the next range), doc_id, text. Their number follows that of the rows. Only QUANTILES
    numbers come to the driver; of texts only the first of each range is handed on.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // RANGE_ROWS)
    coarse = min(wanted, QUANTILES)
    bounds = sorted({int(b) for b in docs.stat.approxQuantile("doc_id", [i / coarse for i in range(coarse + 1)], 0.1 / coarse)})
    fine = -(-wanted // coarse)
    at = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)  # that many bounds lie below
    if fine > 1 and bounds:
        low, high = (F.coalesce(F.get(F.array(*[F.lit(float(b)) for b in bounds]), k), F.col("doc_id").cast("double")) for k in (at - 1, at))
        step = F.floor(fine * (F.col("doc_id").cast("double") - low) / F.greatest(high - low, F.lit(1.0)))
        part = at.cast("long") * fine + F.least(F.greatest(step, F.lit(0)), F.lit(fine - 1))
    else:
        part = at.cast("long")
    dealt = docs.withColumn("part", part)
    # a row a range: its first id, and the range before it; after the last range comes the first
    least = dealt.groupBy("part").agg(F.min("doc_id").alias("doc_id"))
    order = Window.orderBy("part")
    least = least.select("part", "doc_id", F.lag("part").over(order).alias("before"), F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    least = stored(least.select("part", "doc_id", F.coalesce("before", "last").alias("before")))
    firsts = F.broadcast(least)  # 24 bytes for RANGE_ROWS documents
    heads = dealt.join(firsts, ["part", "doc_id"]).groupBy("before", "doc_id").agg(F.min("text").alias("text"))
    tails = heads.select(F.col("before").alias("part"), F.lit(1).alias("follower"), "doc_id", "text")
    rows = dealt.select("part", F.lit(0).alias("follower"), "doc_id", "text").unionByName(tails)
    return rows.repartition(max(1, wanted // 4), "part").sortWithinPartitions("part", "follower", "doc_id", "text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last quarter replaced by the next text's beginning.

    A task streams its ranges in order and keeps one row back, so a range may be of any size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, follower, id, text, filters)
        for batch in batches:
            for piece in chunks(batch, "text"):
                rows = list(zip(*(piece.column(c).to_pylist() for c in ("part", "follower", "doc_id", "text")), strict=True))
                own = digests([r[3].encode() for r in rows], ranks)
                rows = [(*r, d) for r, d in zip(rows, own, strict=True)]
                todo = [(a, b) for a, b in zip([held, *rows] if held else rows, rows if held else rows[1:], strict=False) if not a[1] and a[0] == b[0]]
                held = rows[-1]
                edited = []
                for a, b in todo:
                    k = len(a[3]) // 4
                    edited.append((a[3][: len(a[3]) - k] + b[3][:k]).encode())
                marks = digests(edited, ranks)
                out = [
                    [None if a[2] == _LEAST else a[2] for a, _ in todo],
                    [len(a[3]) for a, _ in todo],
                    [hashlib.sha256(t).hexdigest() for t in edited],
                    [encode(a[4]) for a, _ in todo],
                    [encode(m) for m in marks],
                    [likeness(a[4], m) for (a, _), m in zip(todo, marks, strict=True)],
                    [likeness(a[4], b[4]) for a, b in todo],
                ]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return in_order(docs).mapInArrow(run, SCHEMA)


def fingerprints(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """doc_id and fingerprint of every text, without shuffling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                own = digests([(t or "").encode() for t in piece.column("text").to_pylist()], ranks)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([encode(d) for d in own], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")
