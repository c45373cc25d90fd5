"""Shortest-pack-first packing over the histogram of piece lengths.

A document's token ids, closed by one end id, are cut into full pieces of ``length`` tokens and a rest. The
histogram of piece lengths (``length`` numbers at most) goes through shortest-pack-first: lengths longest
first, each piece into the pack with the most room that holds it, a new pack otherwise, on counts of packs
of one pattern. Pieces then take the patterns' places by their rank among the pieces of their length.

Ranks are made in two levels, within (length, salt) and by sums over the salts; a length has as many salts as it has
pieces to deal out, so that a length that many documents share, such as that of full pieces, is not one task's work at any
size. Texts are encoded once; what is kept of a piece is six numbers.

Defined results: a null or empty text is the end id alone; rows with one id are packed one by one, in the
order of (doc_id, start, ids_crc32, doc_tokens); exact repeats are told apart by their count. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, stored

LENGTH = 1024
#: Salts a length has at least, and the pieces that one of more salts ranks.
SALTS, RANKED = 64, 1 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@functools.cache
def encoder(path: str):
    """A function from a text to its ids, as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    Where the same vocabulary lies beside the file as ranks and its added tokens are plain strings, the faster library that
    reads those encodes; a test holds both to equal ids. Added tokens that stand in a text are those tokens in either.
    """
    import json
    from pathlib import Path

    ranked = Path(path).with_suffix(".tiktoken")
    added = json.loads(Path(path).read_text(encoding="utf-8"))["added_tokens"]
    plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if ranked.exists() and plain:
        import base64

        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranked.read_bytes().splitlines())}
        found = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added})
        return lambda text: found.encode(text, allowed_special="all")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    return lambda text: found.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """The pieces of every document: full ones and the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                out: list[tuple] = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end_id], "<u4")
                    for s in range(0, len(ids), length):
                        cut = ids[s : s + length]
                        out.append((doc, s, len(cut), zlib.crc32(cut.tobytes()), len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Shortest-pack-first: [(packs, [(piece length, pieces of it in a pack), ...]), ...].

    ``room`` holds, for each number of free tokens, the patterns with that much room and how many packs have them.
    """
    room: list[dict[tuple, int]] = [{} for _ in range(length + 1)]
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            free = next((r for r in range(length, size - 1, -1) if room[r]), None)
            if free is None:  # new packs, one a piece; the emptiest packs are these from now on
                room[length - size][((size, 1),)] = room[length - size].get(((size, 1),), 0) + left
                break
            pattern, packs = next(iter(room[free].items()))
            used = min(packs, left)
            if used == packs:
                del room[free][pattern]
            else:
                room[free][pattern] = packs - used
            grown = (*pattern[:-1], (size, pattern[-1][1] + 1)) if pattern[-1][0] == size else (*pattern, (size, 1))
            room[free - size][grown] = room[free - size].get(grown, 0) + used
            left -= used
    return [(packs, list(pattern)) for found in room for pattern, packs in found.items()]


def places(found: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(piece length, first rank, ranks, first sequence, packs, offset): where the pieces of a length go by rank."""
    out, base, used = [], 0, {}
    for packs, pattern in found:
        offset = 0
        for size, times in pattern:
            rank = used.get(size, 0)
            out.append((size, rank, packs * times, base, packs, offset))
            used[size] = rank + packs * times
            offset += size * times
        base += packs
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, length, end_id))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most length rows
    where = places(patterns(histogram, length))
    many = {size: -(-n // RANKED) for size, n in histogram.items() if n > SALTS * RANKED}
    salts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in many.items() for x in kv]), "length"), F.lit(SALTS)) if many else F.lit(SALTS)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), salts).cast("long"))
    counts = stored(salted.groupBy("length", "salt").count())  # length * SALTS rows, and one a RANKED pieces
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    # the pieces are dealt out by (length, salt) already: Spark's own size check decides whether the counts are broadcast
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(ahead, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("own") + F.col("ahead"))

    lows = {}
    for size, *row in where:
        lows.setdefault(size, []).append(row)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {size: np.array(rows, np.int64) for size, rows in lows.items()}
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            cuts = np.flatnonzero(np.diff(size[order], prepend=-1))
            for at in np.split(order, cuts[1:]) if len(order) else []:
                rows = table[int(size[at[0]])]
                k = np.searchsorted(rows[:, 0], rank[at], side="right") - 1
                within = rank[at] - rows[k, 0]
                sequence[at] = rows[k, 2] + within % rows[k, 3]
                offset[at] = rows[k, 4] + within // rows[k, 3] * size[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    columns = [f.split()[0] for f in PIECES.split(", ")]
    return ranked.select(*columns, F.col("rank").cast("long").alias("rank")).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
