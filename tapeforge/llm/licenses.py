"""License scans: exact phrases and fuzzy short notices.

A text becomes its lower-case words joined by single spaces. A phrase is found where its words stand
consecutively. A notice may differ by a bounded number of edits, but not in the words that tell licenses apart (names and
versions), and it begins and ends with a word: it is split into one seed more than edits, so that by pigeonhole one seed
stands unchanged in every match; around each seed found, the regex library verifies the bounded error and reports the span.

Defined results: a null or empty text has no word, no place and no label (empty strings, score 0). Rows are scanned one
by one, so repeated rows get equal answers. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

#: Phrases whose places are counted, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Short notices that are searched with errors, with their labels. Words between bars stand unchanged.
NOTICES = {
    "licensed under the |apache| license |version 2| 0": "apache-2",
    "released under the |mit| license": "mit",
    "|permission| is hereby |granted| free of charge to any person obtaining a copy": "mit",
    "licensed under the |gnu general| public license": "gpl",
    "licensed under the |gnu lesser general| public license": "lgpl",
    "licensed under the |gnu affero general| public license": "agpl",
    "|redistribution| and use in source and |binary| forms with or without modification are permitted": "bsd",
    "|permission| to use copy |modify| and or |distribute| this software for any purpose": "isc",
    "subject to the terms of the |mozilla| public license": "mpl",
    "licensed under the |eclipse| public license": "epl",
    "creative commons attribution |noncommercial|": "cc-by-nc",
    "creative commons attribution |sharealike|": "cc-by-sa",
    "creative commons attribution |4 0| international": "cc-by",
    "released into the |public domain|": "public-domain",
}
#: One edit for so many characters of a notice.
CHARS_AN_EDIT = 15

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parts(notice: str) -> list[tuple[str, bool]]:
    """The pieces of a notice and whether each stands unchanged."""
    return [(piece, bool(i % 2)) for i, piece in enumerate(notice.split("|")) if piece]


def edits(plain: str) -> int:
    """How many edits a notice may have."""
    return max(1, len(plain) // CHARS_AN_EDIT)


@functools.cache
def _searches() -> tuple[list[tuple], object]:
    """(label, notice, edits, unchanged words, pattern) of each notice, and an automaton of all seeds: [(notice, place), ...] each."""
    import ahocorasick
    import regex

    searches, seeds = [], {}
    for notice, label in NOTICES.items():
        plain = notice.replace("|", "")
        k = edits(plain)
        cuts = [round(i * len(plain) / (k + 1)) for i in range(k + 2)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            seeds.setdefault(plain[a:b], []).append((len(searches), a))
        # the edits of the pieces are bounded together by the search; here each by the whole bound
        body = "".join(rf"(?<![^ ]){regex.escape(x, literal_spaces=True)}(?![^ ])" if fixed else rf"(?:{regex.escape(x, literal_spaces=True)}){{e<={k}}}" for x, fixed in parts(notice))
        searches.append((label, plain, k, [x for x, fixed in parts(notice) if fixed], regex.compile(rf"(?b)(?<![^ ])(?:{body})(?![^ ])")))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    return searches, automaton


def fuzzy(text: str) -> list[tuple[str, int, int, int]]:
    """(label, begin, end, edits) of the notices in a text of lower-case words, ascending and apart for each notice."""
    searches, automaton = _searches()
    near: dict[int, list[tuple[int, int]]] = {}
    for last, (size, places) in automaton.iter(text):
        for which, place in places:
            _, notice, k, _, _ = searches[which]
            begin = last + 1 - size - place
            near.setdefault(which, []).append((max(0, begin - k), begin + len(notice) + k))
    found = []
    for which, spans in near.items():
        label, notice, k, fixed, pattern = searches[which]
        done = 0
        for begin, end in sorted(spans):
            begin = max(begin, done)
            while begin < end and all(text.find(x, begin, end) >= 0 for x in fixed):
                stop = text.find(" ", end)  # whole words only
                match = pattern.search(text, begin, stop if stop >= 0 else len(text))
                if not match:
                    break
                if sum(match.fuzzy_counts) <= k:
                    found.append((label, match.start(), match.end(), sum(match.fuzzy_counts)))
                    done = match.end()
                    break
                begin = match.start() + 1
    return sorted(found, key=lambda m: (m[1], m[2], m[0]))


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of a whole text.

    spans: (label, first word, words, edits) of each notice.
    """
    words = WORD.findall((text or "").translate(_LOWER))
    line = " ".join(words)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        at = line.find(phrase)
        while at >= 0:
            if (at == 0 or line[at - 1] == " ") and (at + len(phrase) == len(line) or line[at + len(phrase)] == " "):
                places.append(at)
                base.add(label)
            at = line.find(phrase, at + 1)
    notices = fuzzy(line)
    begins = list(accumulate((len(w) + 1 for w in words), initial=0)) if places or notices else []  # where each word begins
    starts = [bisect_left(begins, at) for at in places]
    spans, best = [], 1.0 if starts else 0.0
    for label, begin, end, errors in notices:
        first = bisect_left(begins, begin)
        spans.append((label, first, bisect_left(begins, end) - first, errors))
        best = max(best, 1 - errors / (end - begin))
    labels = base | {s[0] for s in spans}
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best, spans)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices array<struct<label:string,first_word:long,n_words:long,edits:long>>"


def licenses(docs: DataFrame) -> DataFrame:
    """The scan of every document, in place: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
        span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())])
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(span)]
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                rows = [scan(t) for t in part.column("text").to_pylist()]
                rows = [(*r[:7], [dict(zip(("label", "first_word", "n_words", "edits"), s, strict=True)) for s in r[7]]) for r in rows]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
