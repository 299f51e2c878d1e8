"""License scans: exact phrases, and fuzzy search of short notices.

A notice with at most k edits, cut into k + 1 seeds, keeps one seed whole (pigeonhole). An
Aho-Corasick automaton finds the seeds; the regex library's bounded-error matching then verifies
the edits around each hit and reports the span.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sunframe.llm.common import ASCII_LOWER, id_and_text, table

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices in normal form (lower-case words, one space between) and their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
)
#: Edits allowed: one for so many characters of a notice.
CHARS_PER_EDIT = 14
#: Words that tell notices apart. A match has exactly those of its notice, unedited.
TELLING = frozenset("nc sa nd mit lesser affero".split())

_TO_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in ASCII_LOWER)
#: Maps a byte to its lower case if it is part of a word, else to a space.
NORMAL = bytes(_TO_WORDS[ASCII_LOWER[c]] if ASCII_LOWER[c] < 128 else c for c in range(256))


@dataclass(frozen=True)
class Scan:
    n_words: int
    starts: tuple[int, ...]
    base_labels: tuple[str, ...]
    labels: tuple[str, ...]
    score: float
    #: (label, first word, end word exclusive, edits) of each notice found.
    spans: tuple[tuple[str, int, int, int], ...]


class LicenseScanner:
    """Scanner of phrases and notices; both are parameters."""

    def __init__(self, phrases: dict[str, str] | None = None, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> None:
        import ahocorasick
        import regex

        self._phrases = [(f" {p} ".encode(), label) for p, label in (PHRASES if phrases is None else phrases).items()]
        self._notices, self._telling, self._cost, seeds = [], [], chars_per_edit, {}
        for number, (notice, label) in enumerate(notices):
            edits = max(1, len(notice) // chars_per_edit)
            pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
            self._notices.append((notice, label, edits, pattern))
            self._telling.append(_telling(notice))
            cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(notice[a:b], []).append((number, a))
        self._seeds = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self._seeds.add_word(seed, (len(seed), uses))
        self._seeds.make_automaton()

    def scan(self, text: str | None) -> Scan:
        """Null counts as empty. A text without words has no places, no labels and score 0."""
        words = (text or "").encode().translate(NORMAL).split(b" ")
        words = [w for w in words if w]
        joined = b" " + b" ".join(words) + b" "
        starts, base = [], set()
        for phrase, label in self._phrases:
            at = joined.find(phrase)
            while at >= 0:
                starts.append(joined.count(b" ", 0, at))
                base.add(label)
                at = joined.find(phrase, at + 1)
        spans = self._fuzzy(joined.decode())
        labels = base | {label for label, *_ in spans}
        score = 1.0 if base else max((1 - edits / length for (_, _, _, edits), length in spans.items()), default=0.0)
        return Scan(len(words), tuple(sorted(starts)), tuple(sorted(base)), tuple(sorted(labels)), score, tuple(sorted(spans, key=lambda s: s[1:])))

    def _windows(self, joined: str) -> dict[int, list[tuple[int, int]]]:
        """Where each notice may lie: ranges around its seed hits, overlapping ones joined up to a bounded length."""
        found: dict[int, list[tuple[int, int]]] = {}
        for end, (length, uses) in self._seeds.iter(joined):
            for number, offset in uses:
                notice, _, edits, _ = self._notices[number]
                start = end + 1 - length - offset
                low, high = max(0, start - 2 * edits), min(len(joined), start + len(notice) + 2 * edits)
                ranges = found.setdefault(number, [])
                if ranges and low <= ranges[-1][1] and high - ranges[-1][0] <= 3 * len(notice):
                    ranges[-1] = (min(low, ranges[-1][0]), max(high, ranges[-1][1]))
                else:
                    ranges.append((low, high))
        return found

    def _fuzzy(self, joined: str) -> dict[tuple[str, int, int, int], int]:
        """Verified notices, with the notice's length; of those that overlap, the longest by what its edits leave."""
        found: set[tuple[int, int, int, int, str, int]] = set()
        for number, ranges in self._windows(joined).items():
            notice, label, _, pattern = self._notices[number]
            for low, high in ranges:
                for m in _hits(pattern, joined, low, high):
                    # Whole words: a match may begin or end inside one, or with a space.
                    start, stop = m.start() + (joined[m.start()] == " "), m.end() - (joined[m.end() - 1] == " ")
                    start, stop = joined.rfind(" ", 0, start) + 1, joined.find(" ", stop)
                    if _telling(joined[start:stop]) == self._telling[number]:
                        first, edits = joined.count(" ", 0, start) - 1, sum(m.fuzzy_counts)
                        found.add((self._cost * edits - len(notice), -len(notice), first, first + joined.count(" ", start, stop) + 1, label, edits))
        return best_apart(found)


def _telling(words: str) -> list[str]:
    return [w for w in words.split() if w in TELLING]


def best_apart(found) -> dict[tuple[str, int, int, int], int]:
    """(label, first word, end word, edits) and the notice's length, of matches that do not overlap: the best first."""
    spans: dict[tuple[str, int, int, int], int] = {}
    starts: list[int] = []
    ends: list[int] = []
    for _, minus, first, end, label, edits in sorted(found):
        at = bisect_left(starts, end)  # the last taken span that starts before this one ends
        if at and ends[at - 1] > first:
            continue
        starts.insert(at, first)
        ends.insert(at, end)
        spans[label, first, end, edits] = -minus
    return spans


def _hits(pattern, joined: str, low: int, high: int):
    """The best match of the range, and those of what is left before and after it."""
    ranges = [(low, high)]
    while ranges:
        low, high = ranges.pop()
        if m := pattern.search(joined, low, high):
            yield m
            ranges += [(low, m.start()), (m.end(), high)]


_SCANNERS: dict[int, LicenseScanner] = {}


def scanner() -> LicenseScanner:
    """The scanner of the fixed phrases and notices, one a worker process."""
    if 0 not in _SCANNERS:
        _SCANNERS[0] = LicenseScanner()
    return _SCANNERS[0]


def license_scans(docs: DataFrame) -> DataFrame:
    """One row a document: words, base places, labels, score and ``spans`` of notices.

    ``score`` is the greatest share of unedited characters of a phrase or notice that was found: 1 with a
    base phrase, which has no edits, and 0 without any. Of notices that overlap only the best counts.
    Null and empty texts, and those without words, have null places, empty labels and score 0. Long texts
    are scanned whole. Each row stands for itself, also with null or repeated ids; repeated rows each stay.
    Columns but ``doc_id`` and ``text`` do not matter. An empty table gives no rows.
    """

    def make():
        def work(texts):
            got = [scanner().scan(t) for t in texts]
            long = pa.int64()
            span = pa.list_(pa.struct([("label", pa.string()), ("first_word", long), ("end_word", long), ("edits", long)]))
            return [
                pa.array([g.n_words for g in got], long),
                pa.array([len(g.starts) for g in got], long),
                pa.array([g.starts[0] if g.starts else None for g in got], long),
                pa.array([g.starts[-1] if g.starts else None for g in got], long),
                pa.array([",".join(g.base_labels) for g in got], pa.string()),
                pa.array([",".join(g.labels) for g in got], pa.string()),
                pa.array([g.score for g in got], pa.float64()),
                pa.array([[dict(zip(("label", "first_word", "end_word", "edits"), s, strict=True)) for s in g.spans] for g in got], span),
            ]

        return work

    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return _with_spans(docs, make, schema)


def _with_spans(docs: DataFrame, make, schema: str) -> DataFrame:
    names = [*(c.split()[0] for c in schema.split(",")), "spans"]

    def run(batches):
        work = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1).to_pylist())], ["doc_id", *names])

    return id_and_text(docs).mapInArrow(run, f"doc_id long, {schema}, spans array<struct<label:string,first_word:long,end_word:long,edits:long>>")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans(table(spark, sf_dir, "documents"))
