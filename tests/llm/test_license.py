"""License scan against a plain search over whole lines."""

import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from ledgerflow.llm import license_scan as ls

TEXTS = [
    None, "", "  \n", "plain words only", "Licensed under CC BY-NC 4.0.", "cc-by; CC\nBY cc by by",
    "All rights reserved. ALL  rights, reserved!", "x all rightsreserved",
    "Licensd under the Apache Licence, Version 2.0.", "Licensed unde the Apache License Version 2 0 and more",
    "Released under the MIT License.", "Releasd undr the MIT licence", "Released under the BSD License",
    "This work is licensed under the GNU General Public License, version 3.",
    "This work is licenced under the GNU Genral Public Licens, version 3.",
    "GNU Lesser General Public License", "GNU Affero General Public License",
    "Ünïcode ©2020 all Rights RESERVED “cc” by", "lorem " * 3000 + "permission is hereby granted, free of charge, to any person obtaining a copy " * 2,
    "Permission is hereby grnted, free off charge, to any persn obtaining a copy",
    "licensed under licensed under the licensed under the apache licensed under the apache license version 2 0",
    "release under the mi licens", "the mit license was released under", "Proprietary and (confidental)",
]


def _line(text):
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def _brute_base(text):
    words = _line(text).split(" ") if _line(text) else []
    out = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(out)


def test_base_and_labels(spark):
    rows = [(i if i else None, t, "x", 7) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, n_words int").repartition(3)
    got = {r["doc_id"]: r for r in ls.scan_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        n, places = _brute_base(text)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert (r["score"] > 0) == bool(places or r["finds"]) and 0 <= r["score"] <= 1
        for f in r["finds"]:
            part = _line(text[f["start"]:f["end"]])
            assert part == " ".join(_line(text).split(" ")[f["first_word"]:f["last_word"] + 1])
    assert ls.scan_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", [t for t in TEXTS if t and t.strip()])
def test_seeds_lose_no_notice(text):
    """A notice is found near a seed exactly when the whole line holds it."""
    scanner, line = ls.Scanner(), _line(text)
    for n, (label, length, edits, pattern) in enumerate(scanner.notices):
        whole = bool(pattern.search(line))
        near = any(pattern.search(line, max(a, 0), min(b, len(line))) for a, b in scanner.candidates(line).get(n, []))
        assert whole == near, (label, line)


def test_expected_labels():
    scanner = ls.Scanner()
    want = {4: "cc-by,cc-by-nc", 8: "apache-2.0", 9: "apache-2.0", 10: "mit", 11: "mit", 12: "bsd", 13: "gpl",
            14: "gpl", 15: "gpl,lgpl", 16: "agpl,gpl", 19: "mit", 23: "proprietary"}
    for i, labels in want.items():
        assert ls.scan(TEXTS[i], scanner)[5] == labels, TEXTS[i]
    edits = [f["edits"] for f in ls.scan(TEXTS[8], scanner)[7]]
    assert edits == [2]


def test_edits_are_levenshtein():
    scanner = ls.Scanner({"abcdefghijklmnopqrst": "x"})
    for line, n in (("zz abcdefghijklmnopqrst zz", 0), ("abcdefghXijklmnopqrst", 1), ("abcdfghijklmnopqrt", 2), ("abcfghijklmnopqt", None)):
        finds = scanner.finds(line)
        assert ([f[3] for f in finds] == [n]) if n is not None else not finds
    assert regex.__name__ == "regex"


def _brute_finds(line, notices):
    """Every substring within a notice's edits, best first, those that overlap none better."""
    found = []
    for notice, label in notices.items():
        size, most = len(notice), max(1, len(notice) // ls.PER_EDIT)
        for start in range(len(line)):
            row = list(range(size + 1))
            for end in range(start + 1, min(len(line), start + size + most) + 1):
                new = [end - start]
                for i in range(size):
                    new.append(min(row[i] + (notice[i] != line[end - 1]), row[i + 1] + 1, new[i] + 1))
                row = new
                if row[size] <= most:
                    found.append((row[size] / size, start - end, label, start, end, row[size]))
    out = []
    for _, _, label, start, end, edits in sorted(found):
        if all(end <= s or e <= start for _, s, e, _ in out):
            out.append((label, start, end, edits))
    return sorted(out, key=lambda f: f[1])


def test_edited_copy_before_a_better_one():
    scanner = ls.Scanner()
    edited, exact = "released under the bit license", "released under the mit license"
    assert [f[1:] for f in scanner.finds(f"{edited} or {exact}")] == [(0, 30, 1), (34, 64, 0)]
    many = scanner.finds(" or ".join([edited] * 40 + [exact] + [edited] * 40))
    assert [f[3] for f in many] == [1] * 40 + [0] + [1] * 40 and {f[0] for f in many} == {"mit"}


@pytest.mark.parametrize("seed", range(6))
def test_all_copies_of_a_stretch(seed):
    """Edited and exact copies amid license-dense prose, against every substring of the line."""
    notices = {n: ls.NOTICES[n] for n in ("released under the mit license", "proprietary and confidential")}
    rng, parts = random.Random(seed), []
    for _ in range(6):
        copy = list(rng.choice(list(notices)))
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = rng.choice(["", "x"])
        parts += ["".join(copy), rng.choice(["or the license", "license", "and", "a license under the license"])]
    line = " ".join(parts)
    got, want = ls.Scanner(notices).finds(line), _brute_finds(line, notices)
    assert len(want) >= 6 and [(f[0], f[3]) for f in got] == [(f[0], f[3]) for f in want]
    assert all(g[1] < w[2] and w[1] < g[2] for g, w in zip(got, want))


def test_long_texts_and_repeated_ids(spark):
    """Five megabytes of hits cost time in proportion, and rows that repeat an id stay."""
    unit = "Released under the MIT License. "
    texts = ["cc-by " * 800_000, unit * 160_000, "x " + unit, "x " + unit]
    started = time.monotonic()
    docs = spark.createDataFrame([(n, t) for n, t in zip((1, 2, 3, 3), texts)], "doc_id long, text string").repartition(4)
    rows = ls.scan_documents(docs).select(
        "doc_id", "n_words", "n_base", "last_word", "labels", F.size("finds").alias("n"),
        F.try_element_at("finds", F.lit(-1)).alias("last")).collect()
    assert time.monotonic() - started < 60
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 4 and sum(r["doc_id"] == 3 and r["n"] == 1 for r in rows) == 2
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["last_word"]) == (1_600_000, 800_000, 1_599_998)
    assert got[2]["labels"] == "mit" and got[2]["n"] == 160_000
    assert (got[2]["last"]["first_word"], got[2]["last"]["last_word"]) == (799_995, 799_999)
    assert (got[2]["last"]["start"], got[2]["last"]["end"]) == (159_999 * 32, 159_999 * 32 + 30)


@pytest.mark.parametrize("text,label", [
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", "isc"),
    ("Altered source versions must be plainly marked as such", "zlib"), ("Distributed under the Boost Software License, Version 1.0.", "bsl-1.0"),
    ("made available under the terms of the Eclipse Public License", "epl"), ("CC0 1.0 Universal (Public Domain Dedication)", "cc0"),
    ("Neither the name of the copyright holder nor the names of its contributers may", "bsd-3-clause"),
    ("Licensed under the Artistic License 2.0", "artistic-2.0"),
])
def test_further_notices(text, label):
    assert label in ls.scan(text, ls._scanner())[5].split(",")
