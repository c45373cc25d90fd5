"""Mixing to target weights by iterative proportional fitting.

Documents are cells of (source, lang, topic). The cells' token weights, first ``budget`` times their tokens, are raked to
each dimension's target shares in turn, and no cell is given more than it has. A document is then kept with
the probability weight / tokens of its cell, by a keyed hash of the document, so that a task that runs again draws the
same documents.

The cells are an aggregate; up to DRIVER_CELLS of them are raked on the driver, more by the same steps as
DataFrame operations. Weights are whole numbers of 1 / UNIT tokens, so that sums don't depend on their order, and both
ways do the same operations on the same numbers: they give equal probabilities, bit for bit, and draw the same documents.
Documents meet their cell's probability in a join that needs no shuffle while the cells' table is
small enough to broadcast by Spark's own size check; a hot cell is split by adaptive execution otherwise.
Up to 2 ** 47 tokens (some 700 TB of text) fit; beyond, sums fail with an error.

Defined results: a null source, lang or topic is a value of its own; null and empty texts have no tokens, and a cell without
tokens keeps the budget's share of its documents; target values that no document has are left out and the rest scaled
up; values without a target keep their own share. Repeated rows are drawn alike. Extra columns pass through, whatever their
names, but for those of the results (``mix_topic``, ``mix_tokens``, ``probability``), which are replaced; a column
``topic`` of the table is used as it is, else topics come from :func:`topic_of`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DIMENSIONS = ("source", "lang", "topic")
DRIVER_CELLS = 200_000
ROUNDS, TOLERANCE = 200, 1e-9
#: A token's weight is a whole number of these parts; shares are whole numbers of SHARE parts.
UNIT, SHARE = 1 << 16, 1 << 52
NULL = "\x00null"

#: Production targets: an exponent flattens a dimension's own shares; a table gives shares outright.
TARGETS = {"source": 0.7, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}, "topic": 0.9}
BUDGET = 0.5


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A plain kind of text: legal, contact, marks, brief, long or prose."""
    low = F.lower(text)
    marks = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
    return (
        F.when(low.contains("license") | low.contains("rights reserved"), "legal")
        .when(text.contains("@") | text.rlike(r"\d{4}"), "contact")
        .when(10 * marks >= tokens, "marks")
        .when(tokens < 50, "brief")
        .when(tokens > 1000, "long")
        .otherwise("prose")
    )


def _celled(docs: DataFrame) -> DataFrame:
    """doc, a struct of all columns of docs, with the columns of its cell, c_source, c_lang and c_topic, and _tokens."""
    named = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    tokens = n_tokens(F.coalesce(named["text"], F.lit("")))
    topic = named["topic"] if "topic" in named else topic_of(F.coalesce(named["text"], F.lit("")), F.col("_tokens"))
    value = {"source": named["source"], "lang": named["lang"], "topic": topic}
    out = docs.select(F.struct("*").alias("doc")).withColumn("_tokens", tokens)
    return out.withColumns({f"c_{d}": F.coalesce(value[d].cast("string"), F.lit(NULL)) for d in DIMENSIONS})


def _goals(cells: DataFrame, dimension: str, target: float | dict[str, float], budget: float) -> DataFrame:
    """value, goal: the weight that each value of a dimension should get, written once."""
    own = cells.groupBy(F.col(f"c_{dimension}").alias("value")).agg(F.sum("tokens").alias("own"))
    own = own.crossJoin(F.broadcast(own.agg(F.greatest(F.sum("own"), F.lit(1)).alias("whole"))))  # a single number is joined
    share = F.col("own") / F.col("whole")
    if isinstance(target, dict):
        table = F.create_map(*[F.lit(x) for k, v in target.items() for x in (k, float(v))]) if target else F.create_map().cast("map<string,double>")
        share = F.coalesce(F.try_element_at(table, F.col("value")), share)
    else:
        share = F.when(F.col("own") > 0, F.pow(share, F.lit(float(target)))).otherwise(0.0)
    parts = stored(own.select("value", "whole", F.rint(share * float(SHARE)).cast("decimal(38,0)").alias("part")))
    both = parts.crossJoin(F.broadcast(parts.agg(F.greatest(F.sum("part").cast("decimal(38,0)"), F.lit(1)).cast("double").alias("all"))))
    goal = F.rint(F.col("part").cast("double") / F.col("all") * (F.col("whole") * float(UNIT) * budget))
    return stored(both.select("value", goal.cast("long").alias("goal")))


def rake(tokens: np.ndarray, groups: list[np.ndarray], goals: list[np.ndarray], budget: float) -> np.ndarray:
    """Cell weights in parts of a token, from the cells' tokens.

    groups[d] has each cell's value number in dimension d, goals[d] the values' goals.
    """
    most = tokens * UNIT
    weight = np.rint(most.astype(float) * budget).astype(np.int64)
    still = _still(int(tokens.sum()), budget)
    for _ in range(ROUNDS):
        before = weight
        for own, goal in zip(groups, goals, strict=True):
            now = np.zeros(len(goal), np.int64)
            np.add.at(now, own, weight)
            factor = np.divide(goal.astype(float), now.astype(float), out=np.ones(len(goal)), where=now > 0)
            weight = np.minimum(np.rint(weight.astype(float) * factor[own]), most.astype(float)).astype(np.int64)
        if np.abs(weight - before).max(initial=0) <= still:
            break
    return weight


def _still(tokens: int, budget: float) -> float:
    """Weights that move by no more than this are done; a few parts are what rounding moves."""
    return max(4.0, TOLERANCE * tokens * UNIT * budget)


def _raked_there(cells: DataFrame, goals: dict[str, DataFrame], budget: float) -> DataFrame:
    """cells with their weight: the steps of :func:`rake` as DataFrame operations, for more cells than the driver should hold."""
    still = _still(int(cells.agg(F.sum("tokens")).first()[0] or 0), budget)
    most = (F.col("tokens") * UNIT).cast("double")
    now = cells.withColumn("weight", F.rint(most * budget).cast("long"))
    for _ in range(ROUNDS):
        now = now.withColumn("before", F.col("weight"))
        for d in DIMENSIONS:
            has = now.groupBy(F.col(f"c_{d}").alias("value")).agg(F.sum("weight").alias("now")).join(goals[d], "value")
            factor = F.when(F.col("now") > 0, F.col("goal").cast("double") / F.col("now").cast("double")).otherwise(1.0)
            now = now.join(has.select(F.col("value").alias(f"c_{d}"), factor.alias("factor")), f"c_{d}")
            now = now.withColumn("weight", F.least(F.rint(F.col("weight").cast("double") * F.col("factor")), most).cast("long")).drop("factor")
        now = stored(now)
        moved = now.agg(F.max(F.abs(F.col("weight") - F.col("before")))).first()[0] or 0  # one number
        now = now.drop("before")
        if moved <= still:
            break
    return now


def probabilities(docs: DataFrame, targets: dict = TARGETS, budget: float = BUDGET, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """c_source, c_lang, c_topic, probability: a row a cell."""
    spark = docs.sparkSession
    keys = [f"c_{d}" for d in DIMENSIONS]
    cells = stored(_celled(docs).groupBy(*keys).agg(F.sum("_tokens").alias("tokens")))
    goals = {d: _goals(cells, d, targets[d], budget) for d in DIMENSIONS}
    if cells.count() > driver_cells:
        weighed = _raked_there(cells, goals, budget)
    else:
        rows = cells.collect()
        groups, wanted = [], []
        for d, key in zip(DIMENSIONS, keys, strict=True):
            goal = {r["value"]: r["goal"] for r in goals[d].collect()}  # no more rows than cells
            number = {v: i for i, v in enumerate(goal)}
            groups.append(np.array([number[r[key]] for r in rows], np.int64))
            wanted.append(np.array(list(goal.values()), np.int64))
        weight = rake(np.array([r["tokens"] for r in rows], np.int64), groups, wanted, budget)
        made = [(*r, w) for r, w in zip(rows, weight.tolist(), strict=True)]
        weighed = spark.createDataFrame(made, ", ".join(f"{k} string" for k in keys) + ", tokens long, weight long")
    chance = F.when(F.col("tokens") > 0, F.col("weight").cast("double") / (F.col("tokens") * UNIT).cast("double")).otherwise(float(budget))
    return stored(weighed.select(*keys, chance.alias("probability")))


def mix(docs: DataFrame, targets: dict = TARGETS, budget: float = BUDGET, seed: str = "mix", driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """The sampled documents: all their columns and mix_topic, mix_tokens, probability."""
    keys = [f"c_{d}" for d in DIMENSIONS]
    chance = probabilities(docs, targets, budget, driver_cells)
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc.doc_id", "doc.text"), F.lit(1 << 52)) / float(1 << 52)
    out = _celled(docs).withColumn("drawn", drawn).join(chance, keys).filter("drawn < probability")
    plain = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("mix_topic", "mix_tokens", "probability")]
    return out.select(*plain, F.nullif("c_topic", F.lit(NULL)).alias("mix_topic"), F.col("_tokens").alias("mix_tokens"), "probability")
