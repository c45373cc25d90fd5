"""String similarity scores and the two choices that need them.

The only Python on the data path: plain functions on short strings inside Arrow-batched UDFs, and only on pairs of spellings or of a
search and a candidate that bounds of DataFrame functions leave.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit a position of ``a``."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & at.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    """100 for equal texts, less by each insertion and deletion."""
    return 100.0 * 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Likeness of the sets of words; 100 where one holds the other, 0 where one is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 100.0
    one, two = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    return max([ratio(one, two), *([ratio(both, one), ratio(both, two)] if both else [])])


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """The best likeness of the shorter text to a piece of the longer one, of its length or cut off at an end."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not a:
        return 100.0 if not b else 0.0
    n = len(a)
    return max(ratio(a, b[max(0, i) : i + n]) for i in range(1 - n, len(b)))


def simplified(text: str) -> str:
    """Lower case, other than letters and digits as spaces."""
    return re.sub(r"[\W_]", " ", text).lower().strip()


def weighted_ratio(a: str, b: str) -> float:
    """The best of several scores, less for those that look at parts.

    From general knowledge of the public algorithm; pinned by its published expectations only.
    """
    a, b = simplified(a), simplified(b)
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if longer < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if longer <= 8 else 0.6
    x, y = set(a.split()), set(b.split())
    token = 100.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))
    token = max(token, partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * token)


def representative(values: list[tuple[str, int]], threshold: float = 90.0) -> str | None:
    """The spelling that stands for a group, from its distinct (spelling, count) in order of first appearance.

    A spelling joins the first cluster whose leader is alike enough. A cluster weighs the squares of its counts: each
    of c equal spellings counts c. The heaviest, on ties the earliest, gives its leader.
    """
    leaders: list[str] = []
    weights: list[int] = []
    for value, count in values:
        if not value.split():  # unlike everything, itself too: every repeat is a cluster, each as heavy as all
            leaders.append(value)
            weights.append(count)
            continue
        k = next((k for k, leader in enumerate(leaders) if token_set_ratio(leader, value) >= threshold), None)
        if k is None:
            leaders.append(value)
            weights.append(count * count)
        else:
            weights[k] += count * count
    return leaders[weights.index(max(weights))] if leaders else None


@F.pandas_udf(StringType())
def fuzzy_representative(tallies: pd.Series) -> pd.Series:
    """Of arrays of (first, value, n) in order of first appearance."""
    return pd.Series([None if t is None else representative([(x["value"], x["n"]) for x in t]) for t in tallies], dtype=object)


MISSING_NAME = "<no-name>"
#: The score from which a quote fits.
LEAST = 150.0


def best_candidate(candidates: list[dict], name: str, symbol: str, least: float = LEAST) -> str | None:
    """The symbol of the quote that fits: candidates are viable and in order of rank, null for an absent name.

    By long names, then by short ones: a key that no candidate has a name under is passed over, one name under it decides,
    else the best sum of the likeness of symbols and of names, if it is good enough.
    """
    if not candidates:
        return None
    if len(candidates) == 1:
        return candidates[0]["symbol"]
    for key in ("longname", "shortname"):
        named = [c for c in candidates if c[key]]
        if not named:
            continue
        if len({c[key] for c in named}) == 1:
            return named[0]["symbol"]
        best, score = None, -1.0
        for c in candidates:
            own = ratio(simplified(c["symbol"]), simplified(symbol)) + weighted_ratio(MISSING_NAME if c[key] is None else c[key], name)
            if own > score:
                best, score = c["symbol"], own
        if score >= least:
            return best
    return None


@F.pandas_udf(DoubleType())
def candidate_score(quote: pd.Series, symbol: pd.Series, theirs: pd.Series, own: pd.Series) -> pd.Series:
    """The score of :func:`best_candidate`, one row a candidate's symbol and name and those that are looked for."""
    rows = zip(quote, symbol, theirs, own, strict=True)
    return pd.Series([ratio(simplified(q), simplified(s or "")) + weighted_ratio(MISSING_NAME if t is None else t, o or "") for q, s, t, o in rows], dtype=float)


_SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789"
#: Of a sign so many are counted by a bit each, 12 signs in a number; what is more is counted together.
_BITS = 5


def outlined(df: DataFrame, **texts: Column) -> DataFrame:
    """df with what the bounds need of each text: lengths, how often each letter and digit stands there, and words. Right for ASCII only, which it says.

    Steps are columns of their own: within one expression each would be computed for every use of it.
    """
    df = df.withColumns({f"{n}_s": F.trim(F.lower(F.regexp_replace(t, "[^A-Za-z0-9]", " "))) for n, t in texts.items()})
    # lambdas, for a few lines of generated code: what is made of 36 expressions each is too long a method to be compiled
    signs = F.array(*[F.lit(c) for c in _SIGNS])
    times = lambda n: F.transform(signs, lambda c: F.length(f"{n}_s") - F.length(F.replace(F.col(f"{n}_s"), c, F.lit(""))))
    df = df.withColumns({f"{n}_w": F.filter(F.split(f"{n}_s", " +"), lambda w: w != "") for n in texts} | {f"{n}_t": times(n) for n in texts})
    one = F.lit(1).cast("long")

    def mask(n: str, first: int) -> Column:
        """Twelve signs' counts, a bit each up to _BITS of them."""
        return F.aggregate(F.slice(f"{n}_t", first + 1, 12), F.lit(0).cast("long"), lambda held, t: held * (1 << _BITS) + F.call_function("shiftleft", one, F.least(t, F.lit(_BITS))) - 1)

    def outline(n: str, text: Column) -> Column:
        s, words, distinct = F.col(f"{n}_s"), F.col(f"{n}_w"), F.array_distinct(f"{n}_w")
        masks = [mask(n, k).alias(f"m{k // 12}") for k in (0, 12, 24)]
        more = F.aggregate(f"{n}_t", F.lit(0), lambda held, t: held + F.greatest(t - _BITS, F.lit(0)))
        return F.struct(
            *masks, more.alias("more"),
            text.rlike(r"^[\x00-\x7F]*$").alias("plain"), F.length(s).alias("n"), (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).alias("gaps"),
            F.size(words).alias("n_words"), F.length(F.array_join(words, " ")).alias("sorted_n"), distinct.alias("words"), F.size(distinct).alias("n_set"), F.length(F.array_join(distinct, " ")).alias("set_n"),
        )

    return df.withColumns({n: outline(n, t) for n, t in texts.items()}).drop(*[f"{n}{x}" for n in texts for x in ("_s", "_w", "_t")])


def common(a: Column, b: Column) -> Column:
    """At least how many letters and digits two outlined texts share: a column to be made before the bounds are, which use it often."""
    return reduce(lambda x, y: x + y, [F.bit_count(a[m].bitwiseAND(b[m])) for m in ("m0", "m1", "m2")]) + F.least(a["more"], b["more"])


def shared(a: Column, b: Column) -> Column:
    """The words that two outlined texts share, another such column."""
    return F.array_intersect(a["words"], b["words"])


def ratio_bound(a: Column, b: Column, m: Column) -> Column:
    """At least the ratio of two simplified texts: a common subsequence has no more of a sign than either text. ``m``: as of :func:`common`."""
    bound = F.when((a["n"] == 0) & (b["n"] == 0), 100.0).otherwise(200.0 * (m + F.least(a["gaps"], b["gaps"])) / (a["n"] + b["n"]))
    return F.when(a["plain"] & b["plain"], bound).otherwise(100.0)


def weighted_bound(a: Column, b: Column, m: Column, words: Column) -> Column:
    """At least :func:`weighted_ratio`; ``m`` and ``words``: as of :func:`common` and :func:`shared`.

    Each of the scores is a ratio of texts whose signs are those of the outlines; a piece of the longer text that shares m signs with
    the shorter one of n has a ratio of at most 2m / (n + m).
    """
    gaps, n_shared, shared_n = F.least(a["gaps"], b["gaps"]), F.size(words), F.length(F.array_join(words, " "))
    ratio_of = lambda x, total: 200.0 * x / F.greatest(total, F.lit(1))
    plain = ratio_of(m + gaps, a["n"] + b["n"])
    m_set = F.least(m + F.least(a["n_set"], b["n_set"]) - 1, a["set_n"], b["set_n"])
    m_sort = m + F.least(a["n_words"], b["n_words"]) - 1
    whole = (n_shared > 0) & ((n_shared == a["n_set"]) | (n_shared == b["n_set"]))
    by_set = F.when(whole, 100.0).otherwise(F.greatest(ratio_of(m_set, a["set_n"] + b["set_n"]), ratio_of(shared_n, shared_n + F.least(a["set_n"], b["set_n"]))))
    near = F.greatest(plain, 0.95 * F.greatest(ratio_of(m_sort, a["sorted_n"] + b["sorted_n"]), by_set))
    piece = lambda x, n: ratio_of(x, n + x)
    scale = F.when(F.greatest(a["n"], b["n"]) <= 8 * F.least(a["n"], b["n"]), 0.9).otherwise(0.6)
    token = F.when(n_shared > 0, 100.0).otherwise(F.greatest(piece(m_set, F.least(a["set_n"], b["set_n"])), piece(m_sort, F.least(a["sorted_n"], b["sorted_n"]))))
    far = F.greatest(plain, scale * piece(m + gaps, F.least(a["n"], b["n"])), 0.95 * scale * token)
    bound = F.when((a["n"] == 0) | (b["n"] == 0), 0.0).when(2 * F.greatest(a["n"], b["n"]) < 3 * F.least(a["n"], b["n"]), near).otherwise(far)
    return F.when(a["plain"] & b["plain"], bound).otherwise(100.0)
