import math
import random
import re
from collections import Counter

import pytest

from ledgerflow.llm import lexical_search, queries

DOCS = "doc_id long, text string, id int, n int, part string, item int, score int, place int"
ITEMS = "item_id long, text string, item int, rank int, doc_id int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, n_docs = sum(n for *_, n in counted), len(counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        best = {}
        for i, c, n in counted:
            m = 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0 and i is not None:
                best[i] = max(s, best.get(i, 0))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(item, r, i, s) for r, (i, s) in enumerate(top, 1)]
    return sorted(out)


def run(spark, docs, items, k=50, width=1 << 16, **options):
    d = spark.createDataFrame([(i, t, 1, 2, "x", 3, 4, 5) for i, t in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], ITEMS)
    got = lexical_search.search(lexical_search.build_index(d, width=width), d, q, k, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()))


def corpus(seed, docs, vocabulary, longest=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["Zé9", "ñ x", "A-B"]
    pick = lambda n: " ".join(words[min(len(words) - 1, int(rng.paretovariate(0.6)))] for _ in range(n))
    return [(i, pick(rng.randint(0, longest))) for i in range(docs)], [(i, pick(rng.randint(1, 12))) for i in range(9)]


def test_equals_scoring_every_document(spark):
    docs, items = corpus(1, 400, 3000)
    docs += [(None, "w1 w2 w3"), (1000, None), (1001, ""), (1002, "- ! ?")]
    docs += [(5, "w7 w8 w9 w7"), (5, docs[5][1])]  # rows that repeat an id
    docs += [(k, "w1 w1 w4 w99 w5") for k in range(2000, 2120)]  # one text, many copies: ties
    items += [(50, None), (51, "nowhere"), (0, "w1 w99"), (52, "W1 w4 W99, w5!")]
    assert run(spark, docs, items) == brute(docs, items)


def test_loose_bounds_take_more_rounds(spark):
    """With few coordinates all bounds are far too high; results stay exact."""
    docs, items = corpus(2, 700, 4000)
    assert run(spark, docs, items, 5, width=16, first=4, growth=3, broadcast=50) == brute(docs, items, 5)


def test_bounds_are_bounds():
    rng = random.Random(3)
    counts = Counter(f"t{rng.randrange(3000)}".encode() for _ in range(20_000))
    at, peaks = lexical_search.sketch(counts, 512)
    import numpy as np

    own = dict(zip(np.frombuffer(at, np.uint16).tolist(), lexical_search.from_narrow(peaks).tolist()))
    for t, tf in counts.items():
        assert own[int(lexical_search._words.of([t])[0] % 512)] >= tf


def test_items_in_blocks(spark):
    docs, items = corpus(4, 150, 400)
    assert run(spark, docs, items, block=(4, 20)) == brute(docs, items)


def test_very_long_text(spark):
    docs, items = corpus(5, 30, 100)
    docs.append((900, " ".join(f"w{k % 90}" for k in range(300_000))))
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "w1")]), ([(1, "w1")], []), ([(1, None)], [(1, "w1")])])
def test_empty(spark, docs, items):
    assert run(spark, docs, items) == []


def test_query_equals_scoring_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_lexical_search(spark, sf).collect())) == brute(docs, items)
