"""Raking against a plain version with floats, both ways against each other, and rows that are hard to mix."""

import random

import pytest
from pyspark.sql import functions as F
from tapeforge.llm import mixing, near_dup

from tests.llm.test_operators import HEAD, prose

KEYS = ["c_source", "c_lang", "c_topic"]


def corpus(spark, seed: int, n: int):
    rng = random.Random(seed)
    rows = [(i, prose(i, rng.randint(1, 60)), rng.choice(["en", "en", "de", "fr", None]), rng.choice(["hot"] * 4 + ["b", "c", None]), 0) for i in range(n)]
    return spark.createDataFrame(rows, HEAD).withColumn("topic", F.when(F.col("doc_id") % 7 < 3, "p").otherwise("q"))


def plain_rake(cells: dict, targets: dict, budget: float, rounds: int) -> dict:
    """Proportional fitting with dictionaries and floats; no cell gets more than its tokens."""
    whole = sum(cells.values())
    weight = {c: t * budget for c, t in cells.items()}
    goals = []
    for d, name in enumerate(("source", "lang", "topic")):
        own = {}
        for c, t in cells.items():
            own[c[d]] = own.get(c[d], 0) + t
        target = targets[name]
        raw = {v: target.get(v, t / whole) if isinstance(target, dict) else (t / whole) ** target for v, t in own.items()}
        goals.append({v: r / sum(raw.values()) * whole * budget for v, r in raw.items()})
    for _ in range(rounds):
        for d, goal in enumerate(goals):
            now = {v: sum(w for c, w in weight.items() if c[d] == v) for v in goal}
            weight = {c: min(w * goal[c[d]] / now[c[d]], cells[c]) for c, w in weight.items()}
    return {c: w / cells[c] for c, w in weight.items()}


TARGETS = [
    ({"source": 0.7, "lang": {"en": 0.4, "de": 0.3, "xx": 0.3}, "topic": 0.9}, 0.3),
    ({"source": {"hot": 0.1, "b": 0.9}, "lang": 1.0, "topic": {"p": 0.5, "q": 0.5}}, 0.2),
    (mixing.TARGETS, mixing.BUDGET),
]


@pytest.mark.parametrize("targets,budget", TARGETS)
def test_raking_against_floats(spark, targets, budget):
    d = corpus(spark, 3, 500)
    cells = {}
    for r in d.collect():
        c = tuple("\x00null" if r[k] is None else r[k] for k in ("source", "lang", "topic"))
        cells[c] = cells.get(c, 0) + len(r["text"].split())
    want = plain_rake(cells, targets, budget, mixing.ROUNDS)
    got = {tuple(r[k] for k in KEYS): r["probability"] for r in mixing.probabilities(d, targets, budget).collect()}
    assert got.keys() == want.keys() and max(abs(got[c] - want[c]) for c in want) < 1e-4


@pytest.mark.parametrize("targets,budget", TARGETS[:1])
def test_both_ways_give_the_same_bits(spark, targets, budget, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 6)
    d = corpus(spark, 4, 300)
    here, there = ({tuple(r[k] for k in KEYS): r["probability"] for r in mixing.probabilities(d.repartition(n), targets, budget, driver_cells=c).collect()} for n, c in ((2, 10**6), (5, 0)))
    assert here == there and len(here) > 20
    one, two = (sorted(r["doc_id"] for r in mixing.mix(d, targets, budget, driver_cells=c).collect()) for c in (10**6, 0))
    assert one == two


def test_own_names_pass_through(spark):
    """Columns named as the operator's own keep their values; those of the results are replaced; all is defined for nulls."""
    names = ["c_source", "c_lang", "c_topic", "_tokens", "doc", "drawn", "tokens", "weight", "value", "goal", "factor", "probability", "mix_topic"]
    d = corpus(spark, 5, 60).drop("topic").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    nulls = spark.createDataFrame([(None,) * len(d.columns)], d.schema)
    twice = d.unionByName(nulls).unionByName(d.filter("doc_id < 20"))
    out = mixing.mix(twice, {"source": 1.0, "lang": 1.0, "topic": 1.0}, 0.6)
    assert out.columns == [c for c in d.columns if c not in ("probability", "mix_topic")] + ["mix_topic", "mix_tokens", "probability"]
    rows = out.collect()
    for r in rows:
        if r["doc_id"] is not None:
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names[:-2]) and r["mix_tokens"] == len(r["text"].split())
    ids = [r["doc_id"] for r in rows]
    assert all(ids.count(i) == 1 + (i < 20) for i in set(ids) - {None})  # repeats are drawn alike
    assert mixing.mix(d.limit(0)).collect() == []


def test_texts_without_tokens_keep_the_budget(spark):
    d = spark.createDataFrame([(i, None if i % 2 else " ", None, "s", 0) for i in range(400)], HEAD)
    out = mixing.mix(d, {"source": 1.0, "lang": 1.0, "topic": 1.0}, 0.5).collect()
    assert 140 < len(out) < 260 and {(r["mix_tokens"], r["probability"]) for r in out} == {(0, 0.5)}


def test_one_document_of_each_group_with_maps(spark):
    """Of rows with one id the least stays, whole, also where a column holds maps, which have no order."""
    texts = [prose(1, 90), prose(1, 90), prose(2, 90)]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], HEAD)
    d = d.unionByName(d.filter("doc_id = 2"))
    d = d.withColumns({"m": F.create_map(F.lit("k"), F.col("doc_id")), "n": F.array(F.struct(F.create_map(F.lit(1), F.lit("v")).alias("x")))})
    rows = sorted(near_dup.deduplicated(d).collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["m"], r["n"][0]["x"]) for r in rows] == [(0, {"k": 0}, {1: "v"}), (2, {"k": 2}, {1: "v"})]
    assert [r["text"] for r in rows] == texts[::2]
    a, b = (d.filter("doc_id = 2").limit(1).withColumn("source", F.lit(s)) for s in "ba")
    assert [r["source"] for r in near_dup.deduplicated(a.unionByName(b)).collect()] == ["a"]
