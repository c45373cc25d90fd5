"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A signature has SYMBOLS symbols of 16 bits. Texts of similarity 0.8 differ in a fifth of the symbols on
average; pairs within DISTANCE differing symbols are candidates. The signature is cut into
``(DISTANCE + 2) // 2`` chunks, so by pigeonhole one chunk of such a pair has at most one differing symbol;
a key for each chunk and each symbol left out finds all of them. Candidates are confirmed on full sets.

Steps: equal sets form one class. Every class is first tried against two others: the first of its buckets and the
predecessor in its buckets that it shares most buckets with. Confirmed links give components; in ROUNDS rounds more two components
that meet in buckets try TRIES pairs. Then all pairs of a bucket that still belong to different components are tried. A group of
copies so costs a few pairs a member, and no pair of different components that shares a key goes untested. Before texts are fetched for a pair, two bits of each symbol
are compared, and the parities of how many shingles fall into each of PARITIES bins: a pair within DISTANCE symbols is within
DISTANCE of the two bits, and each parity that differs takes a shingle that is in one set only, so no link is lost.

Defined results: a null or blank text has no shingle, is linked with nothing and is its own component;
rows with one id count as one document; a row without an id is not linked (component null, kept).
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from .common import chunks, mix, stored, text_bytes, words

SYMBOLS = 96
#: Further rounds of trying TRIES pairs of two components before all pairs that are left are tried; the result is the same for any.
ROUNDS, TRIES = 2, 3
#: A pair of similarity 0.8 has more differing symbols with probability 8e-6: the chance of over 37 in 96 trials of chance 0.2.
DISTANCE = 37
PLANES = [f"plane{k}" for k in range(SYMBOLS // 32)]
#: Bits of a set's parity sketch.
PARITIES = 512
ODDS = [f"odd{k}" for k in range(PARITIES // 64)]
SKETCH = [*PLANES, *ODDS]


def shingles(offsets: np.ndarray, data: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles; of all its words where there are fewer."""
    h, _, _, first = words(offsets, data, lower=True)
    out = []
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(3) + h[k : len(h) - size + 1 + k] + np.uint64(size))
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for x in h[a:b]:
                whole = mix(whole * np.uint64(5) + x + np.uint64(b - a))
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit symbols for each set that isn't empty."""
    sets = [s for s in sets if len(s)]
    if not sets:
        return np.empty((0, SYMBOLS), np.uint16)
    h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SYMBOLS), np.uint32)
    buffer = np.empty_like(h)
    for k, (a, b) in enumerate(zip(*_factors(), strict=True)):
        np.bitwise_xor(h, b, out=buffer)
        np.multiply(buffer, a, out=buffer)
        out[:, k] = np.minimum.reduceat(buffer, starts)
    return (mix(out.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def chunk_bounds() -> list[tuple[int, int]]:
    n = (DISTANCE + 2) // 2
    cuts = [round(i * SYMBOLS / n) for i in range(n + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def keys(signature: np.ndarray) -> np.ndarray:
    """SYMBOLS keys a row: each chunk with each of its symbols left out."""
    out = np.empty(signature.shape, np.uint64)
    wide = signature.astype(np.uint64) + np.uint64(1)
    for c, (a, b) in enumerate(chunk_bounds()):
        for left in range(a, b):
            h = np.full(len(signature), 1000 * c + left, np.uint64)
            for k in range(a, b):
                if k != left:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + wide[:, k])
            out[:, left] = h
    return out


def planes(signature: np.ndarray) -> np.ndarray:
    """Two bits of each symbol, as SYMBOLS // 32 longs a row."""
    two = (signature & np.uint16(3)).astype(np.uint64).reshape(len(signature), -1, 32)
    return (two << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(2, dtype=np.uint64).view(np.int64)


def parities(shingles_of_text: np.ndarray) -> np.ndarray:
    """For each of PARITIES bins whether an odd number of shingles falls into it, as longs."""
    odd = np.bincount((shingles_of_text & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _fit(x: str, y: str) -> Column:
    """What every pair of similarity 0.8 within DISTANCE symbols fulfils, from columns such as x_size, x_plane0, x_odd0.

    Similar sets a, b have 9 * |a xor b| <= |a| + |b|.
    """
    symbols = shingles_apart = F.lit(0)
    for c in PLANES:
        d = F.col(f"{x}_{c}").bitwiseXOR(F.col(f"{y}_{c}"))
        symbols += F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    for c in ODDS:
        shingles_apart += F.bit_count(F.col(f"{x}_{c}").bitwiseXOR(F.col(f"{y}_{c}")))
    sizes = F.col(f"{x}_size"), F.col(f"{y}_size")
    return _similar(*sizes) & (symbols <= DISTANCE) & (9 * shingles_apart <= sizes[0] + sizes[1])


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, the signature and the parities as longs (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = shingles(*text_bytes(part.column("text")), size)
                n = np.array([len(s) for s in sets], np.int64)
                at = np.cumsum(n > 0) - 1
                sig = signatures(sets).view(np.int64)
                one, two = (np.array([int(f(s)) if len(s) else 0 for s in sets], np.uint64).view(np.int64) for f in (lambda s: np.bitwise_xor.reduce(s), lambda s: mix(s ^ np.uint64(0xA5A5A5A5)).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(one), pa.array(two), pa.array([sig[k] if c else None for k, c in zip(at, n, strict=True)], pa.list_(pa.int64())), pa.array([parities(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "h1", "h2", "sig", "odd"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, sig array<long>, odd array<long>")


def _with_planes(classes: DataFrame) -> DataFrame:
    """The signature and the columns of SKETCH."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = batch.column("sig").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(-1, SYMBOLS)
            own = planes(sig)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(own[:, k]) for k in range(own.shape[1]))], names=[*batch.schema.names, *PLANES])

    rows = classes.mapInArrow(run, "id long, size int, sig array<long>, odd array<long>, " + ", ".join(f"{p} long" for p in PLANES))
    return rows.select("id", "size", "sig", *PLANES, *[F.get("odd", F.lit(k)).alias(c) for k, c in enumerate(ODDS)])


def left_out(signature: np.ndarray) -> np.ndarray:
    """The symbol that each key leaves out, -1 for the first of a chunk.

    Two signatures that share a key and whose symbols left out are equal have the whole chunk in common; then they share all its keys,
    and the first stands for them.
    """
    out = signature.astype(np.int32)
    out[:, [a for a, _ in chunk_bounds()]] = -1
    return out


def _keyed(classes: DataFrame) -> DataFrame:
    """key, id, size, own (the symbol left out, null for the first of a chunk): SYMBOLS rows a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                sig = part.column("sig").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(-1, SYMBOLS)
                ids, sizes = (np.repeat(part.column(c).to_numpy(zero_copy_only=False), SYMBOLS) for c in ("id", "size"))
                own = left_out(sig).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys(sig).ravel().view(np.int64)), pa.array(ids), pa.array(sizes), pa.array(own, mask=own < 0)], names=["key", "id", "size", "own"])

    return classes.select("id", "size", "sig").mapInArrow(run, "key long, id long, size int, own int")


def _similar(a: Column, b: Column) -> Column:
    """Sizes that allow a similarity of 0.8."""
    return 100 * F.least(a, b) >= 80 * F.greatest(a, b)


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that may be similar, by their sketches."""
    for c in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("id").alias(c), *[F.col(p).alias(f"{c}_{p}") for p in ("size", *SKETCH)]).hint("merge"), c)
    return pairs.filter(_fit("a", "b")).select("a", "b")


def _confirmed(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= 80 * union."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                own = shingles(*text_bytes(part.column("text")), size)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in own], pa.binary())], names=["id", "words"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("wa"), batch.column("wb"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                at = np.searchsorted(q, p)
                shared = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                ok.append(100 * shared >= 80 * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids.hint("merge"), "id", "left_semi").mapInArrow(sets, "id long, words binary")
    own = stored(own)
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("words").alias("wa")).hint("merge"), "a").join(own.select(F.col("id").alias("b"), F.col("words").alias("wb")).hint("merge"), "b")
    return both.mapInArrow(confirm, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """id, component (the least id reachable) of every id in the edges (a, b), by alternating stars."""
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        check = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if check == seen or not check[0]:
            break
        seen = check
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _mixed(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """key, id, size, own, component, main, sketches: the rows of buckets of several components; main is a bucket's largest."""
    known = classes.select("id", *SKETCH).join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rest = stored(rows.select("key", "id", "size", "own").join(known.hint("merge"), "id"))
    sizes = rest.groupBy("key", "component").count().groupBy("key").agg(F.max(F.struct("count", "component")).alias("most"), F.count("*").alias("n"))
    return stored(rest.join(sizes.filter("n > 1").select("key", F.col("most.component").alias("main")).hint("merge"), "key"))


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document; links are at a similarity of 0.8 or more."""
    signed = _signed(docs, size)
    first = stored(signed)
    linked = first.filter("n_shingles > 0 and doc_id is not null")
    least = stored(linked.groupBy("h1", "h2").agg(F.min("doc_id").alias("class")))  # written, so that adaptive execution can split a set that many documents have
    members = stored(linked.select("doc_id", "n_shingles", "h1", "h2").join(least, ["h1", "h2"]).select("doc_id", "n_shingles", "class"))
    # by its own id: a large group of copies has one row here
    classes = linked.join(least.select(F.col("class").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    classes = classes.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.struct("h1", "h2", F.col("n_shingles").cast("int").alias("size"), "sig", "odd")).alias("x"))  # one row, for rows with one id too
    classes = stored(_with_planes(classes.select("id", "x.size", "x.sig", "x.odd")))

    w = Window.partitionBy("key").orderBy("id")
    entry = F.struct("id", "size")
    rows = _keyed(classes).select("key", "id", "size", "own", F.first(entry).over(w).alias("head"), F.lag(entry).over(w).alias("prev"), F.lead("id").over(w).alias("next"))
    rows = stored(rows.filter("prev is not null or next is not null").drop("next"))  # buckets of one are done
    tried = rows.select(F.col("id").alias("b"), "size", F.posexplode(F.array("head", "prev")).alias("kind", "other"))
    tried = tried.filter((F.col("other.id") < F.col("b")) & _similar(F.col("size"), F.col("other.size"))).groupBy("b", "kind", F.col("other.id").alias("a")).count()
    tried = tried.groupBy("b", "kind").agg(F.max(F.struct("count", (-F.col("a")).alias("less"))).alias("most")).select((-F.col("most.less")).alias("a"), "b").distinct()
    pairs = stored(_near(tried, classes))
    edges = stored(_confirmed(docs, pairs, size))

    labels = components(edges)
    # buckets of several components: each round, two components that meet in buckets try a few of the pairs that fit there
    for turn in range(ROUNDS):
        rest = _mixed(rows, classes, labels)
        # a row a bucket and component: its first member there stands for it, so that a large component makes no more of them
        firsts = rest.groupBy("key", "component", "main").agg(F.min(F.struct("id", "size", *SKETCH)).alias("x"))
        p, q = (firsts.select("key", "component", "main", *[F.col(f"x.{c}").alias(f"{x}_{c}") for c in ("id", "size", *SKETCH)]) for x in "pq")
        out = q.filter("component <> main").join(p.filter("component = main").drop("component", "main").hint("merge"), "key").filter(_fit("p", "q"))
        both = F.struct(F.least("p_id", "q_id").alias("a"), F.greatest("p_id", "q_id").alias("b"))
        some = [F.max_by(both, F.xxhash64("p_id", "q_id", F.lit(TRIES * turn + k))).alias(f"try{k}") for k in range(TRIES)]
        tried = out.groupBy("component", "main").agg(*some).select(F.explode(F.array(*[f"try{k}" for k in range(TRIES)])).alias("x")).select("x.*").distinct()
        near = stored(tried.join(pairs, ["a", "b"], "left_anti"))
        found = stored(_confirmed(docs, near, size))
        pairs = stored(pairs.unionByName(near))
        if found.isEmpty():
            break
        labels = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(found))

    # then every pair that is left: rows outside the largest component of a bucket meet all its rows, copies of one text never
    rest = _mixed(rows, classes, labels)
    p, q = (rest.select("key", "main", *[F.col(c).alias(f"{x}_{c}") for c in ("id", "size", "own", "component", *SKETCH)]) for x in "pq")
    once = F.coalesce(F.col("p_own") != F.col("q_own"), F.lit(True))  # a chunk in common counts once, not by each of its keys
    fits = (F.col("p_component") != F.col("q_component")) & once & _fit("p", "q")
    left = p.drop("main").join(q.filter("q_component <> main").hint("merge"), "key").filter(fits).select(F.least("p_id", "q_id").alias("a"), F.greatest("p_id", "q_id").alias("b")).distinct()
    more = stored(stored(left).join(pairs, ["a", "b"], "left_anti"))  # written first: else Spark moves the join below the distinct
    if not more.isEmpty():
        labels = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(_confirmed(docs, more, size)))

    found = members.join(labels.select(F.col("id").alias("class"), "component"), "class", "left").select("doc_id", "n_shingles", F.coalesce("component", "class").alias("component_id"))
    alone = first.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _holds_map(kind.elementType)


def deduplicated(docs: DataFrame, size: int = 5) -> DataFrame:
    """The documents that are kept, with all their columns; of rows with one id the least."""
    kept = stored(near_duplicates(docs.select("doc_id", "text"), size).filter("kept and doc_id is not null").select("doc_id").distinct())
    rows = docs.filter(F.col("doc_id").isNotNull()).join(kept.hint("merge"), "doc_id", "left_semi")
    other = [c for c in docs.columns if c != "doc_id"]
    row, unordered = F.struct(*other), [f.name for f in docs.schema if _holds_map(f.dataType)]
    if unordered:  # maps have no order: the text of theirs takes their place in it
        least = F.min_by(row, F.struct(*[F.to_json(F.struct(c)) if c in unordered else F.col(c) for c in other]))
    else:
        least = F.min(row)
    rows = rows.groupBy("doc_id").agg(least.alias("row")).select("doc_id", "row.*").select(*docs.columns)
    return rows.unionByName(docs.filter(F.col("doc_id").isNull()))
