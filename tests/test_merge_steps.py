"""The merge keeps least places by hashing, and orders only what a task may."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapeforge.operators import keyed, merge
from tapeforge.schemas import AMOUNT, FIELDS, field_type


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_are_kept_by_hashing(spark):
    rows = spark.sql("select 'K' as k, 'a' as name, array('XNYS') as mics, 0 as feed_rank, 1L as row_ord")
    order = ["feed_rank", "row_ord"]
    for df in (merge.cells(rows, "k", order, ["name"], "string").groupBy("k", "value").agg(F.min("ord")), merge.spellings(rows, "k", order, ["name"]), merge.codes(rows, "k", order)):
        assert "SortAggregate" not in plan(df)


def test_places_order_as_the_columns_do(spark):
    """At the ends of the types, with nulls, which stand first, and with places within a row."""
    rows = [(r, o, w) for r in (None, -(2**31), -1, 0, 3, 2**31 - 1) for o in (None, -(2**63), -1, 0, 1, 2**63 - 1) for w in (0, 1, 2**31 - 1)]
    df = spark.createDataFrame(rows, "feed_rank int, row_ord long, w int")
    order = ["feed_rank", "row_ord"]
    placed = df.select("*", merge.place(df, order).alias("p"), merge.place(df, order, "w").alias("q")).collect()
    least = lambda x: (x is not None, x or 0)
    assert len(placed) == len(rows) and None not in {r["p"] for r in placed} | {r["q"] for r in placed}
    assert [tuple(r)[:3] for r in sorted(placed, key=lambda r: r["q"])] == sorted(rows, key=lambda r: (least(r[0]), least(r[1]), r[2]))
    assert len({r["p"] for r in placed}) == 36 and len({r["q"] for r in placed}) == len(rows)


@pytest.mark.parametrize("ordered", [5, 1 << 16])
def test_medians_either_way(spark, monkeypatch, ordered):
    """Keys of more listings than a task orders, and of fewer, to the same amounts."""
    monkeypatch.setattr(keyed, "ORDERED", ordered)
    n = {"A" * 12: 4, "B" * 12: 5, "C" * 12: 6, "D" * 12: 31}
    rows = [(k, i, Decimal(i * 7 % size) if i % 5 else None) for k, size in n.items() for i in range(size)]
    given = spark.createDataFrame(rows, f"share_class_figi string, row_ord long, last_price {AMOUNT.simpleString()}")
    full = given.select(F.lit(0).alias("feed_rank"), "row_ord", *[F.col(f) if f in given.columns else F.lit(None).cast(field_type(f)).alias(f) for f in FIELDS])
    want = {}
    for k in n:
        d = sorted(v for key, _, v in rows if key == k and v is not None)
        want[k] = (d[(len(d) - 1) // 2] + d[len(d) // 2]) / 2
    assert {r["share_class_figi"]: r["last_price"] for r in merge.merge_listings(full).select("share_class_figi", "last_price").collect()} == want


def test_a_lone_spelling_goes_through_no_python(spark, monkeypatch):
    """Python is given only arrays of two spellings and more."""
    given = []
    monkeypatch.setattr(merge, "fuzzy_representative", lambda c: given.append(c) or F.lit("python"))
    df = spark.sql("select stack(2, array(named_struct('first', 1, 'value', 'One', 'n', 3L)), array(named_struct('first', 1, 'value', 'One', 'n', 3L), named_struct('first', 2, 'value', 'Two', 'n', 1L))) as v")
    assert [r[0] for r in df.select(merge.leading(F.col("v"))).collect()] == ["One", "python"]
    assert [r[0] for r in df.select(given[0].isNull()).collect()] == [True, False]
