"""Exact medians where one key has all rows and as many distinct values."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapeforge.operators import keyed


def middle(values):
    d = sorted(values)
    return (d[(len(d) - 1) // 2] + d[len(d) // 2]) / 2


@pytest.mark.parametrize("ordered, parts", [(16, 8), (1, 2), (50, 1024)])
def test_medians_by_narrowing_against_sorting(spark, monkeypatch, ordered, parts):
    """Even and heavy-tailed values, far apart and next to each other, repeated ones, a null key, and keys of few values."""
    monkeypatch.setattr(keyed, "ORDERED", ordered)
    monkeypatch.setattr(keyed, "PARTS", parts)
    rng = random.Random(3)
    groups = {
        "even": [Decimal(rng.randrange(10**6)) / 100 for _ in range(400)],
        "tail": [Decimal(10) ** rng.randrange(-14, 17) * rng.choice([1, -1]) for _ in range(401)],
        "near": [Decimal(10**16) + Decimal(rng.randrange(300)) / 10**14 for _ in range(300)],
        "two": [Decimal(-5)] * 150 + [Decimal(7)] * 150,
        "gap": [Decimal(i) for i in range(100)] + [Decimal(10**17 + i) for i in range(100)],
        None: [Decimal(i * i) for i in range(200)],
        "one": [Decimal("1.5")],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("one", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v decimal(32,14)").repartition(3)
    assert {r["k"]: r["v"] for r in keyed.median_exact(df, "k", "v").collect()} == {k: middle(v) for k, v in groups.items()}


def test_no_task_orders_a_hot_key(spark, monkeypatch):
    """Of 50,000 distinct values of one key a task orders 64 at most: what is left of each range says so."""
    monkeypatch.setattr(keyed, "ORDERED", 64)
    counts = spark.range(50_000).select(F.lit("k").alias("k"), (F.col("id") * 7919 % 50_021).cast("decimal(32,14)").alias("v"), F.lit(1).cast("long").alias("_n"))
    hot = counts.groupBy("k").agg(F.sum("_n").alias("_all"), F.count("*").alias("_values"), F.min("v").alias("_low"), F.max("v").alias("_high"))
    left = keyed.narrowed(counts, hot, ["k"], "v").collect()
    assert [r["_rank"] for r in sorted(left, key=lambda r: r["_rank"])] == [24_999, 25_000] and max(r["_values"] for r in left) <= 64
    values = sorted(i * 7919 % 50_021 for i in range(50_000))
    assert keyed.median_exact(counts, "k", "v").first()["v"] == Decimal(values[24_999] + values[25_000]) / 2
