import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import deleted_interpolation as lm
from ledgerflow.llm import queries, sampling

FIELDS = "doc_id long, text string, id int, chunk int, learnt int, deleted int, score double"


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def counts(docs, order):
    """Counts of n-grams by their tokens, with ``order - 1`` begins before a text."""
    out = Counter()
    for text in docs:
        t = [b" "] * (order - 1) + tokens(text)
        for i in range(order - 1, len(t)):
            for m in range(1, order + 1):
                out[tuple(t[i - m + 1:i + 1])] += 1
    return out


def estimates(text, c, n, begun, order):
    """Of each token: the estimates of all orders, and the bucket of its weights."""
    t = [b" "] * (order - 1) + tokens(text)
    for i in range(order - 1, len(t)):
        f, bucket = [], 0
        for m in range(1, order + 1):
            context = tuple(t[i - m + 1:i])
            seen = n if m == 1 else begun if set(context) == {b" "} else c[context]
            f.append(c[tuple(t[i - m + 1:i + 1])] / seen if seen else 0.0)
            if m > 1 and seen:
                bucket = (m - 1) * lm.BITS + seen.bit_length()
        yield f, bucket


def brute(rows, learnt, weights, order):
    taught = [t for i, t in rows if learnt(i)]
    c = counts(taught, order)
    n = sum(len(tokens(t)) for t in taught)
    v = len({t for text in taught for t in tokens(text)})
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((c[(t,)] + 1) / (n + 1 * (v + 1))) for t in own)
        score = sum(math.log10(weights[b][0] / (v + 1) + sum(x * y for x, y in zip(weights[b][1:], f)))
                    for f, b in estimates(text, c, n, len(taught), order))
        out.append((i, len(own), sum(c[(t,)] > 0 for t in own), n, base, score))
    return out


def corpus(seed, docs):
    rng = random.Random(seed)
    return [(i, " ".join(f"W{min(60, int(rng.paretovariate(0.5)))}" for _ in range(rng.randint(0, 40)))) for i in range(docs)]


def close(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    np.testing.assert_allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_plain_counting(spark, order):
    rows = corpus(1, 300)
    rows += [(5, "w1 w2 again"), (5, "w1 w2 again"), (None, "W1 stray"), (400, None), (401, ""), (402, " \t\n"),
             (403, "never seen words"), (404, "w1 w2 " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, 1, 1, 1, 0.5) for i, t in rows], FIELDS).repartition(3)
    learnt = F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True))
    model = lm.learn(docs, learnt, order=order, chunk=500)
    close([tuple(r) for r in model.scores().collect()],
          brute(rows, lambda i: i is None or i % 7 != 2, model.weights, order))
    other = lm.score_documents(docs.repartition(2), learnt, order=order)  # other chunks
    close([tuple(r) for r in other.collect()], [tuple(r) for r in model.scores().collect()])


def test_weights_make_the_kept_out_tokens_likeliest(spark):
    """Up to what buckets borrow from one another and the width of a cell."""
    rng = random.Random(2)
    rows = [(i, t + " " + " ".join(f"pair{k} of{k}" for k in rng.choices(range(30), k=5))) for i, t in corpus(2, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r[0] for r in docs.where(F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(lm.DELETED)) == 0).collect()}
    assert 15 < len(left) < 70
    kept = [t for i, t in rows if i not in left]
    c, n = counts(kept, 2), sum(len(tokens(t)) for t in kept)
    v = len({t for _, text in rows for t in tokens(text)})
    seen = [x for i, t in rows if i in left for x in estimates(t, c, n, len(kept), 2)]
    weights = lm.learn(docs).weights
    assert np.allclose(weights.sum(axis=1), 1) and (weights[lm.BITS:] > 0).all() and (weights[:lm.BITS, 2] == 0).all()

    def likelihood(w):
        return sum(math.log(w[b][0] / (v + 1) + w[b][1] * f[0] + w[b][2] * f[1]) for f, b in seen)

    best = likelihood(weights)
    for part in range(3):
        for share in (0.05, 0.2, 0.5):
            moved = weights * (1 - share)
            moved[:, part] += share
            moved *= weights > 0
            assert likelihood(moved / moved.sum(axis=1, keepdims=True)) < best + 0.02 - 4 * (share > 0.1)


def test_probabilities_add_up(spark):
    """Over all words that can follow, and one unknown, the probabilities sum to 1."""
    docs = spark.createDataFrame(corpus(3, 200), "doc_id long, text string")
    model = lm.learn(docs)
    words = sorted({w for _, t in corpus(3, 200) for w in tokens(t)[:-1]})
    test = spark.createDataFrame([(-1 - k, f"w1 {w.decode()}") for k, w in enumerate([*words, b"unknown"])], "doc_id long, text string")
    both = lm.learn(docs.union(test), F.col("doc_id") >= 0)
    assert np.allclose(both.weights, model.weights)
    score = {r["id"]: r["score"] for r in both.scores().where("id < 0").collect()}
    # p(w1) p(w | w1) p(end | w): take out p(w1) and p(end | w) with plain counts
    c = counts([t for _, t in corpus(3, 200)], 2)
    n, v = sum(len(tokens(t)) for _, t in corpus(3, 200)), len(words) + 1
    total = 0.0
    for k, w in enumerate([*words, b"unknown"]):
        f = [x for x in estimates(f"w1 {w.decode()}", c, n, 200, 2)]
        p = [both.weights[b][0] / (v + 1) + both.weights[b][1] * x + both.weights[b][2] * y for (x, y), b in f]
        total += 10 ** score[-1 - k] / p[0] / p[2]
    end = both.weights[f[1][1]]
    total += end[0] / (v + 1) + end[1] * c[(b"\n",)] / n + end[2] * c[(b"w1", b"\n")] / c[(b"w1",)]
    assert total == pytest.approx(1, abs=1e-9)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_lm_score(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {r[0] for r in docs.where(sampling.fold(F.col("doc_id"), 7) == 2).select("doc_id").collect()}
    model = lm.learn(docs, sampling.fold(F.col("doc_id"), 7) != 2)
    close([(r[0], *r[2:]) for r in got], brute(rows, lambda i: i not in held, model.weights, 2))
    assert {r["doc_id"] for r in got if r["held_out"]} == held
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_nothing_learnt_and_nothing_at_all(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 1, 1, 1, 0.5), (2, None, 1, 1, 1, 1, 0.5)], FIELDS)
    got = sorted(tuple(r) for r in lm.score_documents(docs, F.lit(False)).collect())
    assert got == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert lm.score_documents(docs.limit(0)).collect() == []
