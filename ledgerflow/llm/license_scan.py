"""License scan: exact phrases, and short notices with a bounded number of edits.

Words are runs of digits, lower-cased letters and non-ASCII characters; everything else
separates them. The scanned line is the words joined by one space.

*Base phrases* stand word for word. *Notices* may hold up to one edit in ten characters:
each notice is split into one more seed than it may have edits, so at least one seed of any
match is exact (pigeonhole). One Aho-Corasick pass over the line finds all seeds; around
each the ``regex`` library's bounded-error matching decides and gives span and edits. Of
overlapping finds the one with the smaller share of edits, then the longer, stands; what it
leaves free of a stretch is searched again, before it and behind it, so a better copy never
hides another one. Copies without edits are placed before any fuzzy search.

Defined results: NULL is empty; a text without words has no finds and score 0; finds of
repeated notices count each; rows that repeat an id are returned each; an empty table gives
an empty result; other columns are not read. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import accumulate

from pyspark.sql import DataFrame

from ledgerflow.llm.rows import id_and_text, map_rows

BASE = {b"cc by": "cc-by", b"general public license": "gpl", b"all rights reserved": "reserved"}

# fixed values: wording of common short notices, as words
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "apache license version 2 0 january 2004": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released under the bsd license": "bsd",
    "licensed under the gnu general public license": "gpl",
    "gnu general public license as published by the free software foundation": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "subject to the terms of the mozilla public license": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "all rights reserved": "reserved",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "proprietary and confidential": "proprietary",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "altered source versions must be plainly marked as such": "zlib",
    "this software is provided as is without any express or implied warranty": "zlib",
    "under the terms of the eclipse public license": "epl",
    "distributed under the boost software license version 1 0": "bsl-1.0",
    "cc0 1 0 universal public domain dedication": "cc0",
    "has waived all copyright and related or neighboring rights": "cc0",
    "licensed under the artistic license 2 0": "artistic-2.0",
    "redistributions of source code must retain the above copyright notice": "bsd",
    "redistributions in binary form must reproduce the above copyright notice": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "licensed under the academic free license version 3 0": "afl-3.0",
    "sil open font license version 1 1": "ofl-1.1",
    "python software foundation license version 2": "psf-2.0",
    "gnu free documentation license": "gfdl",
    "creative commons attribution noderivatives": "cc-by-nd",
    "microsoft public license ms pl": "ms-pl",
    "do what the fuck you want to public license": "wtfpl",
}
PER_EDIT = 10  # characters of a notice for each edit allowed
STRETCH = 4  # windows of a notice that one stretch spans at most, so long texts cost linear time

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, finds array<struct<label: string, first_word: long, last_word: long, start: long, end: long, edits: int>>")


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, seed): ``edits + 1`` parts of about equal length."""
    cut = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:])]


def _places(line: str, notice: str, lo: int, hi: int) -> Iterator[int]:
    """Where the notice stands in a stretch of the line."""
    at = line.find(notice, lo, hi)
    while at >= 0:
        yield at
        at = line.find(notice, at + 1, hi)


class Scanner:
    def __init__(self, notices: dict[str, str] | None = None, per_edit: int = PER_EDIT):
        import ahocorasick
        import regex

        self.notices = []
        self.exact = list(NOTICES if notices is None else notices)
        found: dict[str, list[tuple[int, int]]] = {}
        for notice, label in (NOTICES if notices is None else notices).items():
            edits = max(1, len(notice) // per_edit)
            self.notices.append((label, len(notice), edits, regex.compile(f"(?b)(?:{regex.escape(notice, special_only=True)}){{e<={edits}}}")))
            for offset, seed in seeds(notice, edits):
                found.setdefault(seed, []).append((len(self.notices) - 1, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, where in found.items():
            self.automaton.add_word(seed, (len(seed), where))
        self.automaton.make_automaton()

    def candidates(self, line: str) -> dict[int, list[list[int]]]:
        """For each notice stretches of the line that can hold it: every seed's window lies
        whole in one of them; windows that are close share one."""
        out: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(line):
            for n, offset in where:
                _, length, edits, _ = self.notices[n]
                lo = last + 1 - size - offset - edits
                hi = lo + length + 2 * edits
                spans = out.setdefault(n, [])
                both = [min(lo, spans[-1][0]), max(hi, spans[-1][1])] if spans else [lo, hi]
                if spans and lo <= spans[-1][1] and spans[-1][0] <= hi and both[1] - both[0] <= STRETCH * (hi - lo):
                    spans[-1] = both
                else:
                    spans.append([lo, hi])
        return out

    def finds(self, line: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, edits) in the line, in order, not overlapping."""
        best: list[tuple] = []  # the best find of each stretch, the best of all first
        starts: list[int] = []
        ends: list[int] = []
        out: list[tuple[str, int, int, int]] = []

        def search(n: int, lo: int, hi: int) -> None:
            label, length, most, pattern = self.notices[n]
            if hi - lo >= length - most and (m := pattern.search(line, lo, hi)):
                edits = sum(m.fuzzy_counts)
                heappush(best, (edits / length, m.start() - m.end(), label, m.start(), m.end(), edits, n, lo, hi))

        def take(label: str, start: int, end: int, edits: int) -> None:
            at = bisect_right(ends, start)
            if at == len(starts) or starts[at] >= end:
                starts.insert(at, start)
                ends.insert(at, end)
                out.append((label, start, end, edits))

        def search_free(n: int, lo: int, hi: int) -> None:
            first, last = bisect_right(ends, lo), bisect_left(starts, hi)
            for a, b in zip([lo, *ends[first:last]], [*starts[first:last], hi]):
                search(n, a, b)

        found = [(n, max(lo, 0), min(hi, len(line))) for n, spans in self.candidates(line).items() for lo, hi in spans]
        # finds without edits come first whatever else there is, and need no fuzzy search
        for less, label, start in sorted((-len(self.exact[n]), self.notices[n][0], at) for n, lo, hi in found
                                         for at in _places(line, self.exact[n], lo, hi)):
            take(label, start, start - less, 0)
        for n, lo, hi in found:
            search_free(n, lo, hi)
        while best:
            _, _, label, start, end, edits, n, lo, hi = heappop(best)
            take(label, start, end, edits)
            search_free(n, lo, hi)
        return sorted(out, key=lambda f: f[1])


def base_places(words: bytes) -> list[tuple[int, str]]:
    """(word, label) of every place of a base phrase; ``words`` joined by one space."""
    line, out = b" " + words + b" ", []
    for phrase, label in BASE.items():
        phrase = b" " + phrase + b" "
        at, counted, word = line.find(phrase), 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)  # from the last place on, so every byte once
            counted = at
            out.append((word, label))
            at = line.find(phrase, at + 1)
    return sorted(out)


def _word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words stand in the text, in characters."""
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", "a", text))]


def scan(text: str, scanner: Scanner) -> tuple:
    words = text.encode().translate(_TABLE).split()
    line = b" ".join(words)
    base = base_places(line)
    line = line.decode()
    finds = scanner.finds(line)
    rows, score = [], 1.0 if base else 0.0
    if finds:
        spans = _word_spans(text)
        after = list(accumulate(len(w) + 1 for w in line.split(" ")))  # where the next word starts
        for label, start, end, edits in finds:
            first, last = bisect_right(after, start + 1), bisect_right(after, max(start + 1, end - 1))
            rows.append({"label": label, "first_word": first, "last_word": last,
                         "start": spans[first][0], "end": spans[last][1], "edits": edits})
            score = max(score, 1.0 - edits / (end - start))
    base_labels = {label for _, label in base}
    return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {r["label"] for r in rows})), score, rows)


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


def scan_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: the id, base counts and labels, all labels, a score (1 for an
    exact phrase, otherwise the best find's share of unedited characters, 0 without finds)
    and the finds with their words, characters (end exclusive) and edits."""

    def make():
        scanner = _scanner()
        return lambda i, t: (i, *scan(t, scanner))

    return map_rows(id_and_text(docs, text, key), make, SCHEMA).withColumnRenamed("id", key)
