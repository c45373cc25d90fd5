"""Language by cross-parsing entropy.

A suffix automaton is built of labelled text of each language. A text is parsed greedily into the longest
phrases that occur in that language's text; the language that needs the fewest phrases for its length wins.
The texts of a batch walk the automata in step, one symbol a turn, in segments of SEGMENT code points. A segment is first
parsed as if a phrase began there; then the phrase left open by the segment before is carried on into it until both
parses are in one state, from where they agree. So the count is that of the whole text.

The fit is bounded by parameters: the LANGUAGES labels with most texts; of each whole texts of at most LONGEST code points,
those of at most SHORT first, by least hash of their id, at most TRAIN_DOCS, none after TRAIN_CHARS code points are
reached. A window's group limit keeps TRAIN_DOCS rows a task before anything is shuffled.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing was
learned. Ties go to the alphabetically first language. The score is 1 - fewest / second fewest phrases, and 1 for a
single language. Repeated rows get equal answers. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRAIN_DOCS, TRAIN_CHARS, SHORT, LONGEST, LANGUAGES = 16, 64_000, 4000, 100_000, 100
SEGMENT = 512
#: Code points that are parsed at once; a longer text by itself.
BATCH = 1_000_000


def normal(text: str) -> str:
    """Lower case; every run of code points that aren't letters is one space."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


class Automaton:
    """The suffix automaton of some texts over the symbols 0 to size - 1, as a dense table of next states.

    States are held times ``size``; 0 means that no phrase is open, and the root is the second row.
    """

    def __init__(self, texts: list[np.ndarray], size: int):
        n = sum(map(len, texts))
        step = np.zeros((2 * n + 3, size), np.int32)
        link, length = [0] * (2 * n + 3), [0] * (2 * n + 3)
        count = 2
        for text in texts:
            last = 1
            for c in text.tolist():
                q = int(step[last, c])
                if q and length[q] == length[last] + 1:
                    last = q
                    continue
                if q:  # the phrase is known in a longer context only: split it
                    clone = self._split(step, link, length, last, c, q, count)
                    count, last = count + 1, clone
                    continue
                now, count = count, count + 1
                length[now] = length[last] + 1
                p = last
                while p and not step[p, c]:
                    step[p, c] = now
                    p = link[p]
                if not p:
                    link[now] = 1
                else:
                    q = int(step[p, c])
                    if length[q] == length[p] + 1:
                        link[now] = q
                    else:
                        link[now] = self._split(step, link, length, p, c, q, count)
                        count += 1
                last = now
        self.size = size
        self.step = (step[:count] * size).ravel()
        self.restart = step[1] * size  # 0 for an unknown symbol, which is a phrase of its own

    @staticmethod
    def _split(step, link, length, p, c, q, clone) -> int:
        length[clone] = length[p] + 1
        step[clone] = step[q]
        link[clone] = link[q]
        link[q] = clone
        while p and step[p, c] == q:
            step[p, c] = clone
            p = link[p]
        return clone

    def _walk(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state of each lane, and whether a phrase ended before this symbol."""
        found = self.step.take(state + symbols)
        ended = found == 0
        return np.where(ended, self.restart.take(symbols), found), ended

    def phrases(self, columns: np.ndarray, live: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Phrases that begin in each segment; ``columns`` has a row a turn, and the first ``live[t]`` segments are longer than t.

        ``before``: the segment that each one carries on, -1 for none; that one is of full length.
        """
        turns, lanes = columns.shape
        states, counts = np.zeros((turns, lanes), np.int32), np.zeros((turns, lanes), np.int32)
        state, count = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        for t, (symbols, n) in enumerate(zip(columns, live.tolist(), strict=True)):
            state[:n], ended = self._walk(state[:n], symbols[:n])
            count[:n] += ended
            states[t], counts[t] = state, count
        if before is None:
            return count
        last, size = state, (np.arange(turns)[:, None] < live_sizes(live, lanes)).sum(0)
        todo = np.flatnonzero(before >= 0)
        opened = last.copy()  # the state at the end of each segment; of those that never agree it is put right below
        while len(todo):
            on, now, begun = todo, opened[before[todo]], np.zeros(len(todo), np.int32)
            was = opened[todo].copy()
            for t in range(turns):
                inside = size[on] > t
                if not inside.all():  # ended before both parses agreed
                    count[on[~inside]] = begun[~inside]
                    on, now, begun = on[inside], now[inside], begun[inside]
                if not len(on):
                    break
                now, ended = self._walk(now, columns[t, on])
                begun = begun + ended
                agree = now == states[t, on]
                if agree.any():
                    at = on[agree]
                    count[at] = begun[agree] + counts[-1, at] - counts[t, at]
                    opened[at] = last[at]
                    on, now, begun = on[~agree], now[~agree], begun[~agree]
            count[on], opened[on] = begun, now  # they never agreed
            todo = np.flatnonzero(np.isin(before, todo[opened[todo] != was]))  # what comes after these starts from another state
        return count


def live_sizes(live: np.ndarray, lanes: int) -> np.ndarray:
    """How long each segment is, from how many are longer than each turn."""
    return np.searchsorted(-live, -np.arange(lanes), side="left")


class Model:
    """The languages' automata over one alphabet: space, the letters of the labelled texts, and any other letter."""

    def __init__(self, texts: dict[str, list[str]]):
        texts = {k: [normal(t) for t in v] for k, v in sorted(texts.items())}
        letters = sorted({c for v in texts.values() for t in v for c in t} - {" "})
        self.languages = list(texts)
        self.alphabet = {c: i + 1 for i, c in enumerate(letters)}
        self.size = len(letters) + 2
        self.table = np.full(0x110000, self.size - 1, np.uint16)
        for c in range(0x110000):
            if not chr(c).isalpha():
                self.table[c] = 0
        # capitals by their own entry, so that a text needn't be lowered
        for c in range(0x3000):
            low = chr(c).lower()
            if len(low) == 1 and low in self.alphabet:
                self.table[c] = self.alphabet[low]
        for c, i in self.alphabet.items():
            self.table[ord(c)] = i
        self.automata = [Automaton([self.symbols(t) for t in v], self.size) for v in texts.values()]

    def symbols(self, text: str) -> np.ndarray:
        return self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.symbols(t or "") for t in texts]
        known = np.array([bool(c.any()) for c in coded], bool)
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        segments = [(len(c[s : s + SEGMENT]), i, s) for i, c in enumerate(coded) if known[i] for s in range(0, len(c), SEGMENT)]
        segments.sort(key=lambda x: -x[0])
        if segments:
            size = np.array([n for n, _, _ in segments])
            columns = np.zeros((len(segments), size[0]), np.int32)
            for row, (n, i, s) in enumerate(segments):
                columns[row, :n] = coded[i][s : s + n]
            columns = np.ascontiguousarray(columns.T)
            live = np.searchsorted(-size, -np.arange(len(columns)), side="left")
            owner = np.array([i for _, i, _ in segments])
            place = {(i, s): row for row, (_, i, s) in enumerate(segments)}
            before = np.array([place.get((i, s - SEGMENT), -1) for _, i, s in segments])
            for k, automaton in enumerate(self.automata):
                np.add.at(total[k], owner, automaton.phrases(columns, live, before))
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        best = total.argmin(0)
        ordered = np.sort(total, axis=0)
        score = 1 - ordered[0] / np.maximum(ordered[min(1, len(ordered) - 1)], 1) if len(ordered) > 1 else np.ones(len(texts))
        return [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], [float(s) if k else 0.0 for s, k in zip(score, known, strict=True)]


_MODELS: dict[int, Model] = {}


def _model(texts: dict[str, list[str]]) -> Model:
    """The automata, built once a worker."""
    key = hash(tuple((k, tuple(v)) for k, v in sorted(texts.items())))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(texts)
    return _MODELS[key]


def training(docs: DataFrame) -> dict[str, list[str]]:
    """The labelled texts to learn from; ``docs`` has doc_id, text and lang of those that may be used."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.char_length("text") <= LONGEST) & F.col("text").rlike(r"\p{L}"))
    labels = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    order = Window.partitionBy("lang").orderBy(F.char_length("text") > SHORT, F.xxhash64("doc_id"), "text")
    rows = usable.select("lang", "doc_id", "text").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TRAIN_DOCS)
    sofar = F.sum(F.char_length("text")).over(Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("sofar", F.coalesce(sofar, F.lit(0))).filter(F.col("sofar") < TRAIN_CHARS).join(F.broadcast(labels), "lang", "left_semi")  # LANGUAGES rows
    out: dict[str, list[str]] = {}
    for r in rows.select("lang", "text").orderBy("lang", "rank").collect():  # bounded: TRAIN_DOCS a language, of LANGUAGES
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def predict(docs: DataFrame, texts: dict[str, list[str]]) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(texts)
        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text")
            start = 0
            while start < batch.num_rows:
                held, end = 0, start
                own = []
                while end < batch.num_rows and (held < BATCH or end == start):
                    own.append(text[end].as_py())
                    held += len(own[-1] or "")
                    end += 1
                langs, scores = model.predict(own)
                yield pa.RecordBatch.from_arrays([ids.slice(start, end - start), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
                start = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
