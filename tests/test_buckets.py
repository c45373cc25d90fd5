"""Tables in buckets: what a change touches, rivals, repeated batches, and streams on top of them."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tapeforge.schemas import FIELDS, FINANCIALS, IDENTITY, field_type
from tapeforge.sources import buckets, store
from tapeforge.streaming import incremental


def rows(spark, pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def newest(old, new):
    return old.join(new.select("k"), "k", "left_anti").unionByName(new)


def held(spark, path):
    return {r["k"]: r["v"] for r in buckets.read(spark, path).collect()}


def records(spark, given):
    """Canonical records by (number, name, at), ``at`` for their order."""
    df = spark.createDataFrame([(f"{k:012d}", n, at) for k, n, at in given], "figi string, name string, at long")
    known = {"share_class_figi": F.col("figi"), "name": F.col("name"), "symbol": F.lit("S")}
    own = df.select("at", *[known.get(f, F.lit(None)).cast(field_type(f)).alias(f) for f in FIELDS])
    return own.select("at", F.struct(*IDENTITY).alias("identity"), F.struct(*FINANCIALS).alias("financials"))


def test_a_batch_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.replace(rows(spark, ((k, "old") for k in range(1000))), path, ["k"], 32)
    before = buckets.manifest(spark, path)
    changed = buckets.change(rows(spark, ((k, "new") for k in range(0, 1000, 100))), path, ["k"], newest)
    after = buckets.manifest(spark, path)
    assert len(changed) <= 10
    assert {b for b in range(32) if before.folders.get(b) != after.folders.get(b)} == set(changed)
    assert held(spark, path) == {k: "old" if k % 100 else "new" for k in range(1000)}
    # the older version is still whole, and what it alone had goes with it
    assert {r["v"] for r in buckets.read(spark, path, number=0).collect()} == {"old"}
    buckets.prune(spark, path, keep=1)
    assert buckets.versions(spark, path) == [1] and len(held(spark, path)) == 1000
    assert not any((tmp_path / "t" / "data" / f).exists() for b in changed for f in before.folders[b])


def test_the_last_of_repeated_keys_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    assert set(store.upsert_canonical(records(spark, [(1, "A", 0), (1, "C", 2), (1, "B", 1), (2, "X", 0)]), path, "at")) <= set(range(buckets.BUCKETS))
    assert [r["identity"]["name"] for r in store.load_canonical(spark, path).collect()] == ["C", "X"]
    store.upsert_canonical(records(spark, [(2, "Y", 7), (2, "Z", 7)]), path, "at")  # equals: the greatest record
    assert [r["identity"]["name"] for r in store.load_canonical(spark, path).collect()] == ["C", "Z"]
    assert store.get_canonical(spark, path, f"{2:012d}")["identity"]["name"] == "Z"


def test_rivals_lose_nothing(spark, tmp_path):
    """Four writers at once, each with keys of its own and one of all; every change comes through."""
    path = str(tmp_path / "t")
    buckets.replace(rows(spark, [(-1, "start")]), path, ["k"], 4)

    def write(i):
        buckets.change(rows(spark, [(i * 10 + j, f"w{i}") for j in range(5)] + [(-1, f"w{i}")]), path, ["k"], newest)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    found = held(spark, path)
    assert {k: v for k, v in found.items() if k >= 0} == {i * 10 + j: f"w{i}" for i in range(4) for j in range(5)}
    assert found[-1] in {f"w{i}" for i in range(4)}
    assert buckets.read(spark, path).count() == 21 and buckets.versions(spark, path) == [0, 1, 2, 3, 4]


def test_rivals_that_add(spark, tmp_path, monkeypatch):
    """Files that are added and buckets that are written anew in between: each row is there once."""
    monkeypatch.setattr(buckets, "FOLDERS", 2)
    path = str(tmp_path / "t")

    def write(i):
        for j in range(3):
            buckets.change(rows(spark, [(i * 100 + j * 10 + n, "x") for n in range(4)]), path, ["k"], None, 2, f"w{i}", j)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    assert sorted(r["k"] for r in buckets.read(spark, path).collect()) == sorted(i * 100 + j * 10 + n for i in range(3) for j in range(3) for n in range(4))


def test_one_of_two_writers_gets_the_number(spark, tmp_path):
    path = str(tmp_path / "t")
    draft = buckets.Manifest(0, ["k"], 4, rows(spark, []).schema.json())
    assert buckets.commit(spark, path, draft)
    assert not buckets.commit(spark, path, draft)
    assert [p.name for p in (tmp_path / "t" / "manifests").glob("*.json")] == ["0000000000.json"]
    with pytest.raises(ValueError):
        buckets.change(rows(spark, [(1, "a")]), path, ["v"], None)


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1, 0):
        buckets.change(rows(spark, [(batch, "x")]), path, ["k"], None, 4, "w", batch)
    assert sorted(r["k"] for r in buckets.read(spark, path).collect()) == [0, 1]


def test_first_seen_reads_touched_buckets_only(spark, tmp_path):
    """Batches of random keys against plain Python; a batch of one key reads one bucket's files, however long the history."""
    path, rng, want = str(tmp_path / "t"), random.Random(1), {}
    run = incremental.running_first(path, n_buckets=8)
    for batch in range(6):
        given = [("f", rng.choice([None, *map(str, range(30))]), batch * 100 + i) for i in range(25)]
        for _, k, at in sorted(given, key=lambda r: r[2]):
            want.setdefault(k, at)
        df = spark.createDataFrame(given, "feed string, feed_key string, row_ord long").repartition(3)
        run(df, batch)
        run(df, batch)  # again, as after a crash
    assert {r["feed_key"]: r["row_ord"] for r in buckets.read(spark, path).collect()} == want
    assert buckets.read(spark, path).count() == len(want)
    one = spark.createDataFrame([("f", "3", 999)], "feed string, feed_key string, row_ord long")
    found = buckets.manifest(spark, path)
    [bucket] = buckets.touched(one, ["feed", "feed_key"], 8)
    read = buckets.read_of_keys(spark, path, one).inputFiles()
    assert len(read) == len(found.folders[bucket]) < len(buckets.read(spark, path).inputFiles()) and all(f"_bucket={bucket}/" in f for f in read)
    run(one, 6)
    after = buckets.manifest(spark, path)
    assert after.folders == found.folders  # it was seen: nothing is written


def test_a_stream_rewrites_touched_securities_only(spark, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "l")
    run = incremental.upsert_batch(table, path, n_buckets=16)

    def batch(keys, price, at):
        given = {"share_class_figi": F.lpad(F.col("k").cast("string"), 12, "0"), "name": F.lit("N"), "symbol": F.lit("S"), "last_price": F.lit(price)}
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        return df.select(F.lit("sec").alias("feed"), F.lit(3).alias("feed_rank"), (F.col("k") + at).alias("row_ord"), *[given.get(f, F.lit(None)).cast(field_type(f)).alias(f) for f in FIELDS])

    run(batch(range(60), 4, 0), 0)
    before = buckets.manifest(spark, table).folders
    for _ in range(2):
        run(batch([7], 8, 100), 1)
    after = buckets.manifest(spark, table).folders
    assert sum(before.get(b) != after.get(b) for b in range(16)) == 1
    prices = {r["identity"]["share_class_figi"]: r["financials"]["last_price"] for r in store.load_canonical(spark, table).collect()}
    assert len(prices) == 60 and prices.pop(f"{7:012d}") == 6 and set(prices.values()) == {4}
