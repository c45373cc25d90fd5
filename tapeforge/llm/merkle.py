"""A Merkle manifest of a table, with a proof for every row.

Leaves are hashed where the rows are read, so texts never move. Their places within a source come from a range partitioning: a
task's rows are numbered as they stand, and the counts of (task, source) say how many rows stand before. A tree is cut into
superblocks of ``3 ** LEVELS`` consecutive nodes. Upwards each superblock becomes one node, and so do superblocks of those, until
one is left; downwards the nodes of a superblock are cogrouped with the one row of outer nodes that all of them need, which
finishes the local reduction, joins both parts of the proof and folds it. A source of any size is many superblocks, and no group
holds more than ``3 ** LEVELS`` rows. The sources' roots are a tree of their own by the same steps.

Defined results: a null field is written ``-``; a null doc_id stands first in its source and isn't tampered with; rows with one
doc_id stand in order of their leaves, and exact repeats have proofs of their own; a null source is a source, the first; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Nodes that become one, and the levels that a superblock spans.
FAN, LEVELS = 3, 7
BLOCK = FAN**LEVELS


def encoded(field: Column) -> Column:
    """A field's bytes: ``-`` for null, else their count, a colon and the value."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df, written once, with ``pos``, a row's place from 0 within its group, and ``n``, the group's rows.

    Only (task, group) counts are summed up: as many rows as tasks and groups together.
    """
    sort = [*group, *order]
    rows = stored(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_row", F.monotonically_increasing_id()))
    task = F.shiftrightunsigned("_row", 33).alias("_task")
    counts = rows.groupBy(task, *group).agg(F.min("_row").alias("_first"), F.count("*").alias("_own"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_own").over(w.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("_task").alias("_t"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], (before - F.col("_first")).alias("_shift"), F.sum("_own").over(w).alias("n"))
    same = F.shiftrightunsigned("_row", 33) == F.col("_t")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(starts, same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias("pos"), "n")


def depth(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels of a superblock, its nodes first; a last run of fewer, even of one, is hashed too."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest(*nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        out.append(nodes)
    return out


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """The other nodes of the run of a superblock's node at each level: ``left|right``, each side joined."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % FAN
        out.append(f"{''.join(nodes[first:at])}|{''.join(nodes[at + 1 : first + FAN])}")
        at //= FAN
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a node and the siblings on its way give."""
    for step in path:
        left, _, right = step.partition("|")
        node = digest(left, node, right)
    return node


def _block(pos: str = "pos") -> Column:
    return F.floor(F.col(pos) / BLOCK).alias("block")


def _lifted(nodes: DataFrame) -> DataFrame:
    """A node for each superblock of (tree, pos, n, node)."""

    def lift(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n = int(part["n"].iloc[0])
        top = reduced(list(part["node"]), min(LEVELS, depth(n)))[-1][0]
        return pd.DataFrame({"tree": part["tree"].iloc[:1], "pos": part["pos"].iloc[:1] // BLOCK, "n": [-(-n // BLOCK)], "node": [top]})

    return nodes.select("tree", "pos", "n", "node", _block()).groupBy("tree", "block").applyInPandas(lift, "tree long, pos long, n long, node string")


def grown(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, their superblocks' nodes, and so on to a table with one node a tree; all are written."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(stored(_lifted(out[-1])))
        most = -(-most // BLOCK)
    return out


def _lowered(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """The outer row of each node: what the outer row of its superblock says, with the superblock's siblings before its path."""

    def lower(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part, over = part.sort_values("pos"), above.iloc[0]
        levels = reduced(list(part["node"]), min(LEVELS, depth(int(part["n"].iloc[0]))))
        first = int(part["pos"].iloc[0])
        return pd.DataFrame({"tree": part["tree"], "block": part["pos"], "subroot": over["subroot"], "root": over["root"], "path": [[*siblings(levels, int(p) - first), *over["path"]] for p in part["pos"]]})

    left = nodes.select("tree", "pos", "n", "node", _block()).groupBy("tree", "block")
    return left.cogroup(outer.groupBy("tree", "block")).applyInPandas(lower, OUTER)


OUTER = "tree long, block long, subroot string, root string, path array<string>"
PROVED = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _outer_rows(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """The outer rows of the superblocks of ``levels[0]``; ``top`` has those of the trees."""
    for nodes in reversed(levels[1:]):
        top = stored(_lowered(nodes, top))
    return top


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    text, doc = F.col("text"), F.col("doc_id").cast("long")
    fields = [doc, F.col("source"), F.col("lang"), F.col("n_chars").cast("long")]
    cut = F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tampered = F.when(cut & F.contains(text, F.lit("\n")), leaf(*fields, F.replace(text, F.lit("\n"), F.lit(""))))
    leaves = docs.select(doc.alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(*fields, text).alias("node"), tampered.alias("tampered"))
    rows = placed(leaves, ["source"], ["doc_id", "node"])
    sources = placed(rows.select("source", "n").distinct().withColumnRenamed("n", "leaves"), [], ["source"])
    numbered = sources.select(F.col("source").alias("_source"), F.col("pos").alias("tree"))
    rows = stored(rows.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).select("tree", "pos", "n", F.col("doc_id").cast("string").alias("doc_id"), "node", "tampered"))  # as text: pandas has no null integers
    own = grown(rows.select("tree", "pos", "n", "node"))

    # the trees' roots are the nodes of one more tree, whose own root ends it
    subroots = own[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "node")
    upper = grown(stored(subroots.join(sources.select("pos", "n"), "pos").select("tree", "pos", "n", "node")))
    top = upper[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), F.array().cast("array<string>").alias("path"))
    above = _lowered(upper[0], _outer_rows(upper, top)) if len(upper) > 1 else top
    above = stored(above.select(F.col("block").alias("pos"), "root", "path").join(subroots, "pos").select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("node").alias("subroot"), "root", "path"))

    def prove(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        part, over = part.sort_values("pos"), outer.iloc[0]
        levels = reduced(list(part["node"]), min(LEVELS, depth(int(part["n"].iloc[0]))))
        first, path, out = int(part["pos"].iloc[0]), list(over["path"]), []
        for pos, node, bad in zip(part["pos"], part["node"], part["tampered"], strict=True):
            own = [*siblings(levels, int(pos) - first), *path]
            out.append((digest("".join(own).replace("|", "")), fold(node if bad is None else bad, own)))
        proofs, folded = zip(*out, strict=True)
        return pd.DataFrame({"doc_id": part["doc_id"], "leaf": part["node"], "subroot": over["subroot"], "root": over["root"], "proof_sha256": proofs, "folded_root": folded, "verified": [f == over["root"] for f in folded]})

    left = rows.select("tree", "pos", "n", "doc_id", "node", "tampered", _block()).groupBy("tree", "block")
    out = left.cogroup(_outer_rows(own, above).groupBy("tree", "block")).applyInPandas(prove, PROVED)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
