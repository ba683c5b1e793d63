"""Quality and language models: held-out accuracy, fitting code, awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import language_id, logistic, quality, queries, sampling

SF = "/root/testdata/sf0.01"


def test_fold(spark):
    rows = spark.range(50).select(F.col("id"), sampling.fold(F.col("id"), 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 7 != 0, "a").alias("l"))
    a, b = (sampling.sample_per_class(x, "l", "id", 100) for x in (rows, rows.repartition(5)))
    assert sorted(a.collect()) == sorted(b.collect())
    sizes = {r["l"]: r["count"] for r in a.groupBy("l").count().collect()}
    assert sizes.keys() == {"a", "b"} and all(60 <= n <= 140 for n in sizes.values())
    assert sampling.sample_per_class(rows, "l", "id", 5000).count() == rows.where("l is not null").count()
    assert sampling.sample_per_class(rows.limit(0), "l", "id", 5).count() == 0


def test_quality_held_out(spark):
    out = queries.op1_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.mean([r["predicted"] == r["quality"] for r in seen]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in seen)


def test_dual_descent_meets_the_optimum():
    """Against the subgradient optimum of the same problem, found by brute force."""
    rng = np.random.default_rng(1)
    X, y = rng.normal(size=(60, 2)), np.where(rng.random(60) < 0.5, 1, -1)
    X += y[:, None] * 0.8
    cost = np.full(60, 0.3)
    rows = [(np.array([0, 1]), x) for x in X]
    w, b = quality.dual_descent(rows, y, cost, epochs=2000, tol=1e-10)

    def objective(w0, w1, b0):
        return (w0 * w0 + w1 * w1 + b0 * b0) / 2 + (cost * np.maximum(0, 1 - y * (X @ [w0, w1] + b0))).sum()

    best = objective(w[0], w[1], b)
    for _ in range(3000):
        d = rng.normal(size=3) * rng.choice([1e-3, 1e-2, 0.1])
        assert objective(w[0] + d[0], w[1] + d[1], b + d[2]) >= best - 1e-6


def test_quality_features():
    text = "The the the the the the é!! | "
    raw = text.encode()
    want = {(int.from_bytes(raw[i:i + 3], "big") * 0x9E3779B1 % (1 << 32)) >> 14 for i in range(len(raw) - 2)}
    words = raw.split()
    same = [int(a == b) for a, b in zip(words, words[1:])]
    want |= {(1 << 18) + int("".join(map(str, same[i:i + 4])), 2) for i in range(len(same) - 3)}
    assert set(quality.features(text).tolist()) == want
    assert len(quality.features(None)) == len(quality.features("")) == 0


def test_quality_awkward_rows(spark):
    rows = [(i, "good plain words here" if i % 2 else "BAD!! BAD!! BAD!!", "x", 0.0) for i in range(40)]
    rows += [(None, None, None, None), (3, "", "x", 1.0), (3, "good plain " * 30000, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = docs.select("doc_id", "text", quality.score(model, F.col("text")).alias("s")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["s"] <= 1
        if r["text"]:
            assert (r["s"] >= 0.5) == r["text"].startswith("good")
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert quality.fit(docs, none).score("anything") == pytest.approx(1.0)
    assert quality.fit(docs, labels.where("quality = 0")).score("anything") == pytest.approx(0.0)
    assert docs.limit(0).select(quality.score(model, F.col("text"))).count() == 0


def test_logistic():
    x = np.array([-2.0, -1, -0.5, 0.5, 1, 2])
    scale, offset = logistic.scale_and_offset(x, (x > 0.7).astype(float))
    p = 1 / (1 + np.exp(-(scale * x + offset)))
    assert ((p > 0.5) == (x > 0.7)).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7, 30])
def test_code(n):
    words = language_id.code(n)
    assert words.shape[0] == n
    if n > 1:
        gaps = (words[:, None] != words[None]).sum(2) + np.eye(n, dtype=int) * 999
        assert gaps.min() >= max(1, 2 ** (n - 2) if n <= 6 else words.shape[1] // 5)


def test_language_held_out(spark):
    out = queries.op5_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = out.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert out.count() == docs.count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in seen]) >= 0.97


def test_language_awkward_rows(spark):
    rows = [(i, ("the cat and the dog were here" if i % 2 else "der hund und die katze waren hier") + f" {i}", "en" if i % 2 else "de") for i in range(60)]
    rows += [(None, None, "en"), (61, "", "en"), (62, "12 !! 34", "de"), (7, "the thing", None), (7, "the dog " * 200000, None), (None, "die katze", "de")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    model = language_id.fit(docs)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(None, "und"), (61, "und"), (62, "und"), (7, "en"), (None, "de")} <= by
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language_id.fit(docs.limit(0)).predict("the dog") == ("und", 0.0, False)
    assert language_id.fit(docs.where("lang = 'de'")).predict("the dog")[0] == "de"
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_trigrams_over_pieces(monkeypatch):
    text = "abc def, ghi! " * 10
    whole = np.concatenate(list(language_id.trigrams(text)))
    monkeypatch.setattr(language_id, "_AT_ONCE", 16)
    parts = np.concatenate(list(language_id.trigrams(text)))
    assert abs(len(parts) - len(whole)) <= 3 * (len(text) // 16 + 1)


def test_stray_language_values_stop_nothing(spark):
    """Every value is learnt, or those with enough texts; every document is scored."""
    real = [(t, l) for t, l in (("the dog and the cat", "en"), ("der hund und die katze", "de")) for _ in range(20)]
    rows = [(i, t, l) for i, (t, l) in enumerate(real + [("the dog", f"stray {n}") for n in range(10_001)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.fit(docs)
    assert len(model.languages) == 10_003 and model.words.shape == (10_003, 133)
    assert language_id.predict(docs.limit(100), model).count() == 100
    model = language_id.fit(docs, at_least=2)
    assert model.languages == ["de", "en"]
    assert [model.predict(t)[0] for t in ("the dog", "die katze")] == ["en", "de"]
    assert language_id.predict(docs, model).count() == len(rows)
    with pytest.warns(UserWarning):
        sampled = sampling.sample_per_class(docs, "lang", "doc_id", 5)
    assert {"en", "de"} <= {r["lang"] for r in sampled.collect()} and sampled.select("lang").distinct().count() <= sampling.MOST_CLASSES


def test_six_hundred_languages(spark):
    """Languages of made-up words: all learnt, and texts not learnt from are told."""
    def text(n, seed):
        words = np.random.default_rng(n).integers(97, 123, (12, 5))
        pick = np.random.default_rng([n, seed, 1]).integers(0, 12, 40)
        return " ".join("".join(map(chr, words[k])) for k in pick)

    rows = [(n * 4 + k, text(n, k), f"l{n:03d}") for n in range(600) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = language_id.fit(docs, calibrated=1000)
    assert len(model.languages) == 600
    assert np.mean([model.predict(text(n, 99))[0] == f"l{n:03d}" for n in range(0, 600, 3)]) >= 0.97


def test_bit_weights_from_counts(spark):
    rng, languages, words = np.random.default_rng(3), [f"l{n}" for n in range(9)], language_id.code(9)
    counts = {(l, int(g)): float(rng.integers(1, 50)) for l in languages for g in rng.choice(language_id.DIMS, 300, replace=False)}
    frame = spark.createDataFrame([(*k, n) for k, n in counts.items()], "lang string, gram int, n double").repartition(5)
    totals = np.array([sum(n for (l, _), n in counts.items() if l == x) for x in languages])
    share = np.full((9, language_id.DIMS), language_id.SMOOTH)
    for (l, g), n in counts.items():
        share[languages.index(l), g] += n
    share /= share.sum(axis=1, keepdims=True)
    want = np.stack([np.log(share[words[:, b] == 1].mean(axis=0)) - np.log(share[words[:, b] == -1].mean(axis=0)) for b in range(words.shape[1])], axis=1)
    got = language_id.bit_weights(frame, languages, totals, words)
    assert got.shape == want.shape and np.allclose(got, want, atol=1e-5)


def test_sample_of_every_class(spark):
    rows = spark.range(20_000).selectExpr("id", "case when id % 4 = 0 then 'a' when id % 5 = 0 then null when id < 9 then 'c' else 'b' end l")
    got = {r["l"]: r["count"] for r in sampling.sample_every_class(rows, "l", "id", 500).groupBy("l").count().collect()}
    assert got["c"] == rows.where("l = 'c'").count() and set(got) == {"a", "b", "c"}
    assert all(400 < got[l] < 600 for l in "ab")
    old = sampling.sample_per_class(rows, "l", "id", 500)
    assert sampling.sample_every_class(rows.repartition(3), "l", "id", 500).exceptAll(old).count() == 0
    assert {r["l"] for r in sampling.sample_every_class(rows, "l", "id", 500, at_least=100).collect()} == {"a", "b"}
    assert sampling.sample_every_class(rows.limit(0), "l", "id", 5).count() == 0
