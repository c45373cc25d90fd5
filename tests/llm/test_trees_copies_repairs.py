"""The manifest, exact duplicates and conversation repair against brute force, and their stated results for hard rows."""

import hashlib
import heapq
import random
import re
import zlib
from array import array

import duckdb
import pytest
from pyspark.sql import functions as F

from tapeforge.llm import exact_dup, merkle, oracles, repair

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def clashing(df, names):
    """df with columns of names that the operator uses itself."""
    return df.withColumns({c: F.lit(1) for c in names})


# --- manifest


def documents(n, seed=1):
    rng = random.Random(seed)
    texts = [None, "", "a\nb", "\n", "é\U0001f600\n" * 3, "x" * 50_000 + "\ny"]
    rows = [(rng.randrange(-50, 10 * n), rng.choice(["s0"] * 20 + ["", "s", "é", "Z", None]), rng.choice(["en", None]), rng.choice([3, None]), rng.choice(texts)) for _ in range(n)]
    return rows + rows[:3] + [(None, "s0", None, None, "a\nb"), (None, None, None, None, None)]


def plain_manifest(rows):
    """Straight from the definition."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    up = lambda nodes: [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(enc, r)), r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append(up(out[-1]))
        return out

    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: levels([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in names}
    top = levels([own[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            node, proof = sha(*map(enc, (*r[:4], r[4].replace("\n", "")))) if cut else leaf, []
            for tree, i in ((own[s], at), (top, k)):
                for nodes in tree[:-1]:
                    run = range(i - i % 3, min(len(nodes), i - i % 3 + 3))
                    proof += [nodes[j] for j in run if j != i]
                    node = sha(*[node if j == i else nodes[j] for j in run])
                    i //= 3
            out.append((r[0], leaf, own[s][-1][0], top[-1][0], sha(*proof), node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, levels", [(0, 7), (1, 7), (60, 1), (60, 2), (300, 7)])
def test_manifest_against_plain(spark, monkeypatch, n, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows = documents(n) if n else []
    df = clashing(spark.createDataFrame(rows, DOCS), ["pos", "n", "tree", "block", "node", "leaf", "_row", "path"])
    got = sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)
    assert got == plain_manifest(rows)
    assert n < 2 or {r[-1] for r in got} == {True, False}


def test_manifest_of_one_leaf(spark):
    leaf = sha("-", "-", "-", "-", "-")
    assert [tuple(r) for r in merkle.manifest(spark.createDataFrame([(None,) * 5], DOCS)).collect()] == [(None, leaf, leaf, leaf, sha(""), leaf, True)]


def test_places_are_gapless(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1009).alias("x")).repartition(5)
    for r in merkle.placed(rows, ["g"], ["x"]).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("x", "pos", "n"))).alias("all")).collect():
        assert [(p, n) for _, p, n in r["all"]] == [(i, len(r["all"])) for i in range(len(r["all"]))]


# --- exact duplicates


def plain_copies(rows):
    own = {}
    for doc, text in rows:
        own.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""), []).append(doc)
    out = []
    for text, docs in own.items():
        ids = [d for d in docs if d is not None]
        keep, kept = max(ids, default=None), False
        for d in docs:
            stays = d == keep and not kept
            kept = kept or stays
            out.append((d, keep, len(docs), stays, sha(text)))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity, bits, step", [(exact_dup.CAPACITY, 64, 12), (2, 64, 12), (2, 64, 2), (3, 4, 3), (1, 1, 12)])
def test_copies_against_plain(spark, monkeypatch, capacity, bits, step):
    """Small buckets split, few bits of hash make chains of different texts, and a third of all rows are copies."""
    monkeypatch.setattr(exact_dup, "STEP", step)
    rng = random.Random(2)
    rows = [(i, rng.choice(["Hot Text", "hot text"]) if i % 3 == 0 else rng.choice("abcAÉéßẞİ") * rng.randrange(4)) for i in range(300)]
    rows += [(None, "zz"), (None, "ZZ"), (None, None), (None, "alone"), (7, "twice"), (7, "twice"), (7, "other"), (-1, "x" * 200_000), (-2, "X" * 200_000), (-3, "x" * 199_999 + "y")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"), ["hash", "sha", "bucket", "slot", "place", "times", "n_rows", "group_size", "keep_id"]).repartition(3)
    got = sorted((tuple(r) for r in exact_dup.exact_duplicates(df, capacity, bits).collect()), key=str)
    assert got == plain_copies(rows)


def test_no_documents_no_copies(spark):
    assert exact_dup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_the_directory_points_every_slot_to_its_bucket(spark):
    """No bucket is overfull, buckets share no keys, a bucket's parent would be overfull, and the slots are whole."""
    rows = exact_dup.digests(spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    index = exact_dup.build(docs, rows, capacity=20)
    slots = index.directory.collect()
    top = max(r["depth"] for r in slots)
    assert sorted(r["slot"] for r in slots) == list(range(2**top)) and all(r["slot"] >> (top - r["depth"]) == r["bucket"] for r in slots)
    held = {}
    for r in index.keys.collect():
        assert (r["hash"] % 2**64) >> (64 - r["depth"]) == r["bucket"]
        held[r["depth"], r["bucket"]] = held.get((r["depth"], r["bucket"]), 0) + 1
    assert sum(held.values()) == 400 and max(held.values()) <= 20
    for depth, bucket in held:
        assert sum(n for (d, b), n in held.items() if d >= depth - 1 and b >> (d - depth + 1) == bucket >> 1) > 20
    files = index.keys.groupBy(F.input_file_name()).agg(F.min("place").alias("low"), F.max("place").alias("high")).orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:], strict=False))  # owners have ranges of whole buckets


def test_exact_copies_need_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string")
    assert "Python" not in exact_dup.exact_duplicates(df)._jdf.queryExecution().toString()


# --- repair


def cheapest(symbols):
    """Least (cost, audit) by a uniform-cost search over whole paths."""
    heap, seen, follows = [(0, "", 0, 0)], set(), ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
    while True:
        cost, audit, i, s = heapq.heappop(heap)
        if i == len(symbols) and s in (0, 3):
            return cost, audit
        if (i, s) in seen:
            continue
        seen.add((i, s))
        new = 3 if s == 2 else 2
        heapq.heappush(heap, (cost + 2, audit + "I", i, new))
        if i < len(symbols):
            role, fault = divmod(symbols[i], 4)
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s))
            if fault < 2:
                heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, new))
                if role in follows[s]:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, follows[s][role]))


def test_search_against_uniform_cost():
    rng = random.Random(4)
    for k in range(3000):
        symbols = bytes(repair.symbol(rng.randrange(4), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(9)))
        want = cheapest(symbols)
        assert repair.search(symbols) == want
        assert 0 <= want[0] - repair.lower_bounds(symbols)[0] <= 4
        if k % 10 == 0:  # without a lower bound the search only takes more rounds
            assert repair.search(symbols, array("i", bytes(12 * len(symbols) + 12))) == want


@pytest.mark.parametrize("symbols", [bytes(100_000), bytes([4, 8] * 50_000), bytes([5, 4, 2, 8, 12] * 20_000)])
def test_long_conversations_take_time_in_proportion(symbols):
    cost, audit = repair.search(symbols)
    assert cost > len(symbols) or audit == "K" * len(symbols)


def sql_repair(rows):
    con = duckdb.connect()
    con.sql("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    return sorted(con.sql(oracles.OP13_SQL).fetchall(), key=str)


def test_repair_against_sql(spark):
    """Nulls in every column, repeated rows and turns, blank and long texts, odd roles, a conversation of many turns."""
    rng = random.Random(6)
    texts = ["Yes.", "No!", "ok?", "cut", " \t\n\x0b\x0c\r", "", None, "a.\n", "é…", "x" * 20_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)) for _ in range(500)]
    rows += [(99, i, ["user", "assistant"][i % 2], f"{i}.") for i in range(300)] + rows[:20]
    df = clashing(spark.createDataFrame(rows, TURNS), ["copy", "phase", "pos", "code", "kind", "again"]).repartition(3)
    got = sorted((tuple(r) for r in repair.repair(df).collect()), key=str)
    assert got == sql_repair(rows)


def test_a_conversation_of_which_nothing_is_left(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, turn, "user", "a")], TURNS)
    assert [tuple(r) for r in repair.repair(df).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert repair.repair(df.limit(0)).collect() == []
