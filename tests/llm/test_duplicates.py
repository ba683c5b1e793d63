"""Exact, substring and SimHash dedup against brute force, with awkward rows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from brute import components_of, simhash_print

from ledgerflow.llm import components, exact_dedup, simhash, substring_dedup

SCHEMA = "doc_id long, text string, kept string, id string, flags int, _norm string"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    vocab = np.array([f"w{i}" for i in range(60)] + ["Ärger", "naïve", "x y"])
    base = [" ".join(rng.choice(vocab, int(n))) for n in rng.integers(1, 120, 60)]
    rows = list(base)
    for i in range(0, 60, 3):  # near copies, shared passages, other white space
        words = base[i].split(" ")
        rows.append(" ".join([*words[:-1], "changed"]))
        rows.append("Lead in " + base[(i + 1) % 60] + "\n\ttail " + base[i])
        rows.append(base[i].replace(" ", " \n "))
    rows += [None, "", " ", "one", "two words", "same " * 40, "same " * 40, base[0], base[0].upper()]
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "k", "z", 1, "n") for i, t in texts], SCHEMA).repartition(3)


def test_exact(docs, texts):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in texts}
    by = defaultdict(list)
    for i, t in norm.items():
        by[t].append(i)
    got = {r["doc_id"]: r for r in exact_dedup.assign(docs, salts=3).collect()}
    assert got.keys() == norm.keys()
    for i, r in got.items():
        group = by[norm[i]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(group), len(group), i == min(group))
        assert r["text_sha256"] == hashlib.sha256(norm[i].encode()).hexdigest()
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(g) for g in by.values())


def test_exact_awkward_rows(spark):
    rows = spark.createDataFrame([(None, "a"), (2, "a"), (2, "a"), (None, "b"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.assign(rows).collect()), key=str)
    assert got == sorted([(-1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True), (-1, None, 1, True), (3, 3, 2, True), (4, 3, 2, False)], key=str)
    assert sorted((r["doc_id"] or -1) for r in exact_dedup.deduplicate(rows).collect()) == [-1, 2, 3]
    assert exact_dedup.assign(rows.limit(0)).count() == 0
    assert exact_dedup.deduplicate(rows.limit(0)).count() == 0


def _brute_repeats(texts, size):
    words = {i: (t or "").encode().split() for i, t in texts}
    least = {}
    for i, w in words.items():
        for s in range(len(w) - size + 1):
            k = tuple(w[s:s + size])
            least[k] = min(i, least.get(k, i))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - size + 1):
            if least[tuple(w[s:s + size])] < i:
                gone.update(range(s, s + size))
        out[i] = (len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode(), gone)
    return out


@pytest.mark.parametrize("size, chunk", [(13, 1 << 20), (4, 50)])
def test_substring(docs, texts, size, chunk, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    want = _brute_repeats(texts, size)
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(docs, size=size).collect()}
    assert got.keys() == want.keys()
    assert any(w[1] for w in want.values())
    for i, r in got.items():
        n, removed, kept, gone = want[i]
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (n, removed, kept)
        assert {x for a, b in zip(r["removed_from"], r["removed_to"]) for x in range(a, b)} == gone
        assert all(b < a for b, a in zip(r["removed_to"], r["removed_from"][1:]))


def test_substring_chunks_agree(texts):
    """Small chunks send the same flags through the buckets as one large chunk."""
    ids, tokens = [i for i, _ in texts], [substring_dedup._tokens((t or "").encode().split()) for _, t in texts]
    import pandas as pd

    def flags(parts):
        rows = [r for p in parts for r in substring_dedup._chunk([ids[i] for i in p], [tokens[i] for i in p], 5, 4)]
        out = defaultdict(set)
        for _, g in pd.DataFrame(rows, columns=["bucket", "id", "hashes", "holders"]).groupby("bucket"):
            for i, h in substring_dedup._repeats(g).itertuples(index=False):
                out[i].add(h)
        return dict(out)

    every = range(len(ids))
    assert flags([every]) == flags([every[i:i + 7] for i in range(0, len(ids), 7)])


def test_substring_awkward_rows(spark):
    t = " ".join(f"t{i}" for i in range(20))
    rows = spark.createDataFrame([(None, t), (5, t), (5, t), (9, t), (7, None), (8, " \n")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(rows).collect())
    assert got == [(-1, 20, 0), (5, 20, 0), (5, 20, 0), (7, 0, 0), (8, 0, 0), (9, 20, 20)]
    assert substring_dedup.remove_repeats(rows.limit(0)).count() == 0


def test_simhash(docs, texts):
    prints = {i: simhash_print(t) for i, t in texts}
    want = components_of(prints, 2)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_groups(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}


@pytest.mark.parametrize("split", [3, 50_000])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_trie_join(spark, bits, split):
    rng = np.random.default_rng(bits)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64) * np.uint64(2)
    values = {0, (1 << 64) - 1, 1, 1 << 63}
    for c in centre:
        for n in rng.integers(0, 5, 40):
            v = int(c)
            for b in rng.integers(0, 64, n):
                v ^= 1 << int(b)
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for n, a in enumerate(signed) for b in signed[n + 1:] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
    frame = spark.createDataFrame([(v,) for v in signed + signed[:5]] + [(None,)], "fp long")
    got = [tuple(r) for r in simhash.trie_join(frame, bits, split).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_awkward_rows(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (5, "A b  c d"), (5, "a b c d"), (7, None), (8, " ")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_groups(rows).collect())
    assert got == [(-1, 5), (5, 5), (5, 5), (7, 7), (8, 7)]
    assert simhash.near_groups(rows.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, int(x)) for x in rng.integers(201, 300, 80)] + [(5, 5), (3, None), (9, 4), (4, 9)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r["node"]: r["root"] for r in components.connected_components(frame).collect()}
    want = {i: 100 for i in range(100, 161)} | {200: 200, 4: 4, 9: 4} | {b: 200 for a, b in edges if a == 200}
    assert got == want
