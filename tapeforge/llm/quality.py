"""Weak supervision of quality: rules vote or abstain, expectation-maximisation weighs them.

Each rule votes good (1) where its value is plainly good, bad (-1) where it is plainly bad, or abstains (0). The corpus is counted by vote pattern;
on these counts EM estimates the share of good texts and, of each rule, how often it votes bad on good texts and on bad
ones; a rule that abstains adds nothing. A text is kept if its posterior probability of being good is at least one half; ``base_failed`` texts never are.

Defined results: a null text has no words: base_failed. Rows are judged one by one, so repeated rows get equal
verdicts. An empty table has no patterns; the start values hold. Extra columns pass through; those with
names of the results are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, text_bytes, words

#: Symbols that prose has few of.
SYMBOLS = b"#*$%&|<>"
#: Marks that end or part sentences.
SHOUTS = b"!?"

RULES = ("length", "word_length", "symbols", "shouting", "repeats", "lines", "capitals", "letters", "plain_words")
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_shouts long, n_upper long, n_letters long, n_plain long"
WINDOW = 5
ROUNDS = 200
#: Start values of EM and their weight in texts: the share of good texts, bad votes on good texts and on bad ones.
SHARE, FALSE, TRUE, PRIOR = 0.9, 0.01, 0.25, 4.0


def _classes() -> np.ndarray:
    """Bits of each byte: 1 symbol, 2 shout, 4 capital, 8 letter (any byte of a longer code point's start counts)."""
    out = np.zeros(256, np.uint8)
    out[list(SYMBOLS)] |= 1
    out[list(SHOUTS)] |= 2
    out[ord("A") : ord("Z") + 1] |= 12
    out[ord("a") : ord("z") + 1] |= 8
    out[0xC0:] |= 8
    return out


def features(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """The counts named in FEATURES for each text."""
    n = len(offsets) - 1
    h, begin, end, first = words(offsets, data, lower=False)
    n_words = np.diff(first)

    def summed(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total

    starts = summed((data & 0xC0) != 0x80)  # code points before each byte
    per_word = summed(starts[end] - starts[begin])
    word_chars = per_word[first[1:]] - per_word[first[:-1]]
    kinds = _classes()[data]
    symbols, shouts, upper, letters = ((lambda t: t[offsets[1:]] - t[offsets[:-1]])(summed((kinds & k) > 0)) for k in (1, 2, 4, 8))
    # plain words: a letter is in them, and one mark at most comes after the last letter
    letter = (kinds & 8 > 0) | (data >= 0x80)
    some = summed(letter)
    plain = summed((some[end] > some[begin]) & (letter[end - 1] | letter[np.maximum(end - 2, begin)]))
    n_plain = plain[first[1:]] - plain[first[:-1]]
    # words in a window that occurs twice in its text
    repeat = np.zeros(n, np.int64)
    if len(h) >= WINDOW:
        rolled = np.zeros(len(h) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            rolled = mix(rolled * np.uint64(3) + h[k : len(h) - WINDOW + 1 + k])
        owner = np.repeat(np.arange(n), n_words)
        whole = owner[: len(rolled)] == owner[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        key = mix(rolled[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + WINDOW, -1)
        covered = summed(np.cumsum(cover[:-1]) > 0)
        repeat = covered[first[1:]] - covered[first[:-1]]
    # lines with a word, and those equal to an earlier one
    n_lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.flatnonzero(n_words):
        lines = [x for x in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") if x and not x.isspace()]
        n_lines[i], dup[i] = len(lines), len(lines) - len(set(lines))
    return [n_words, word_chars, symbols, dup, repeat, n_lines, shouts, upper, letters, n_plain]


def votes(f: dict[str, np.ndarray]) -> np.ndarray:
    """A row of votes for each text, in the order of RULES."""
    n, chars = np.maximum(f["n_words"], 1), np.maximum(f["word_chars"], 1)

    def judged(value: np.ndarray, fine: float, bad: float) -> np.ndarray:
        """Good up to ``fine``, bad from ``bad`` on; a text without words shows nothing good."""
        return np.where(value >= bad, -1, np.where((value <= fine) & (f["n_words"] > 0), 1, 0))

    mean = f["word_chars"] / n
    return np.stack(
        [
            np.where(f["n_words"] >= 20, np.where(f["n_words"] <= 100_000, 1, 0), np.where(f["n_words"] < 10, -1, 0)),
            np.where((mean < 2) | (mean > 16), -1, np.where((mean >= 3) & (mean <= 10), 1, 0)),
            judged(f["n_symbols"] / n, 0.02, 0.1),
            judged(f["n_shouts"] / n, 0.1, 0.3),
            judged(f["n_repeat_words"] / n, 0.05, 0.2),
            judged(f["n_dup_lines"] / np.maximum(f["n_lines"], 1), 0.2, 0.5),
            judged(f["n_upper"] / np.maximum(f["n_letters"], 1), 0.2, 0.5),
            judged(1 - f["n_letters"] / chars, 0.2, 0.6),
            judged(1 - f["n_plain"] / n, 0.15, 0.4),
        ],
        axis=1,
    ).astype(np.int64)


def code(v: np.ndarray) -> np.ndarray:
    """A vote pattern as one number."""
    return ((v + 1) * 3 ** np.arange(len(RULES))).sum(1)


def measured(docs: DataFrame) -> DataFrame:
    """All columns of docs with the FEATURES and the pattern of votes."""
    names = [f.split()[0] for f in FEATURES.split(", ")] + ["pattern"]
    kept = [c for c in docs.columns if c not in ("text", "quality", "base_failed", "kept", *names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                f = features(*text_bytes(part.column("text")))
                pattern = code(votes(dict(zip(names, f, strict=False))))
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(x, pa.int64()) for x in (*f, pattern))], names=["row", *names])

    rows = docs.select(F.struct(*[F.col(c) for c in kept], F.lit(0).alias("_none_")).alias("row"), F.col("text").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, {FEATURES}, pattern long").select(*[F.col("row")[c].alias(c) for c in kept], *names)


def estimate(counts: dict[int, int]) -> dict[int, float]:
    """The posterior probability of good for each pattern that occurs, by EM over the pattern counts."""
    if not counts:
        return {}
    codes = np.array(sorted(counts))
    weight = np.array([counts[c] for c in codes], float)
    v = codes[:, None] // 3 ** np.arange(len(RULES)) % 3 - 1
    bad, cast = v < 0, v != 0
    share = SHARE  # of good texts
    false, true = np.full(len(RULES), FALSE), np.full(len(RULES), TRUE)  # bad votes among those cast on good texts and on bad ones
    p = np.full(len(codes), share)
    for _ in range(ROUNDS):
        says = np.where(bad, np.log(false / true), np.log((1 - false) / (1 - true))) * cast
        p = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + says.sum(1), -700, 700)))
        w, u = (weight * p)[:, None], (weight * (1 - p))[:, None]
        # PRIOR texts' worth of the start values
        new_share = ((weight * p).sum() + PRIOR * SHARE) / (weight.sum() + PRIOR)
        new_false = np.clip(((w * bad).sum(0) + PRIOR * FALSE) / ((w * cast).sum(0) + PRIOR), 1e-4, 0.999)
        new_true = ((u * bad).sum(0) + PRIOR * TRUE) / ((u * cast).sum(0) + PRIOR)
        # a rule may be useless, its bad votes never speak for a text
        new_true = np.clip(new_true, new_false, 0.9999)
        moved = max(abs(new_share - share), np.abs(new_false - false).max(), np.abs(new_true - true).max())
        share, false, true = new_share, new_false, new_true
        if moved < 1e-12:
            break
    return dict(zip(codes.tolist(), p.tolist(), strict=True))


def _posterior(rows: DataFrame) -> dict[int, float]:
    """From measured rows: at most 3 ** 9 counts go to the driver."""
    return estimate({r["pattern"]: r["count"] for r in rows.groupBy("pattern").count().collect()})


def good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is kept, with all their columns; nothing is shuffled but the counts."""
    posterior = _posterior(measured(docs.select("text")))
    names = [f.split()[0] for f in FEATURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                f = dict(zip(names, features(*text_bytes(part.column("text"))), strict=True))
                fine = np.array([posterior.get(c, 0.0) >= 0.5 for c in code(votes(f)).tolist()], bool)
                yield part.filter(pa.array(fine & ~base_failed(f)))

    return docs.mapInArrow(run, docs.schema)


def base_failed(f: dict):
    """Of arrays or columns of features."""
    return (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])


def judge(docs: DataFrame) -> DataFrame:
    """All columns of docs but the text, its features, base_failed, quality (the posterior) and kept.

    The texts are measured twice, once for the counts of patterns (at most 3 ** 9 numbers, which go to the driver)
    and once for the verdicts; nothing is shuffled but the counts.
    """
    rows = measured(docs)
    table = docs.sparkSession.createDataFrame(list(_posterior(rows).items()), "pattern long, quality double")
    failed = base_failed({c: F.col(c) for c in ("n_words", "n_repeat_words")})
    out = rows.join(F.broadcast(table), "pattern").withColumn("base_failed", failed)  # 3 ** 9 rows at most
    return out.withColumn("kept", ~failed & (F.col("quality") >= 0.5)).drop("pattern")
