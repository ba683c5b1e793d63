"""The registered classifier queries against plain recomputation from the fitted models."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import language_id, quality, queries, sampling

SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def plain_trigrams(text):
    out = [" "]
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif out[-1] != " ":
            out.append(" ")
    if out[-1] != " ":
        out.append(" ")
    for a, b, c in zip(out, out[1:], out[2:]):
        h = (ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA77 + ord(c) * 0xC2B2AE3D) % 2 ** 32
        yield ((h ^ h >> 15) * 0x27D4EB2F) % 2 ** 32 >> 16


def test_language_query_is_loss_weighted_decoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.where(sampling.fold(F.col("doc_id"), 5) != 0))
    bits = range(model.words.shape[1])
    got = {r["doc_id"]: r for r in queries.op5_language_id(spark, SF).collect()}
    for i, text in texts(spark).items():
        grams = list(plain_trigrams(text or ""))
        if not grams:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        margins = [sum(float(model.weights[g, b]) for g in grams) / len(grams) for b in bits]
        loss = [sum(model.trust[b] * math.log1p(math.exp(-word[b] * (margins[b] * model.scale[b] + model.offset[b]))) for b in bits)
                for word in model.words]
        share = [math.exp(min(loss) - x) for x in loss]
        best = max(range(len(share)), key=share.__getitem__)
        assert got[i]["lang_pred"] == model.languages[best]
        assert got[i]["score"] == pytest.approx(share[best] / sum(share), abs=1e-9)
        rest = sorted(share, reverse=True)
        assert got[i]["ambiguous"] == ((rest[0] - rest[1]) / sum(share) < language_id.LEAD)


def plain_features(text):
    raw = text.encode()
    found = {(raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) * 0x9E3779B1 % 2 ** 32 >> 32 - quality.BITS for k in range(len(raw) - 2)}
    words = raw.split()
    same = [a == b for a, b in zip(words, words[1:])]
    found |= {(1 << quality.BITS) + sum(bit << 3 - k for k, bit in enumerate(same[n:n + 4])) for n in range(len(same) - 3)}
    return found


def test_quality_query_is_the_linear_model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in queries.op1_quality(spark, SF).collect()}
    for i, text in texts(spark).items():
        found = plain_features(text or "")
        margin = sum(float(model.weights[f]) for f in found) / math.sqrt(max(1, len(found))) + model.bias
        score = 1 / (1 + math.exp(-(model.scale * margin + model.offset)))
        assert got[i]["score"] == pytest.approx(score, abs=1e-6) and got[i]["predicted"] == int(got[i]["score"] >= 0.5)
