"""Every pipeline stage against a brute-force version, on its own input."""

import re
from collections import defaultdict

import numpy as np
import pytest
from brute import components_of, simhash_print

import corpus_pipeline
from ledgerflow.llm import packing, pii, quality
from ledgerflow.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), "test-stage")
        out[name] = (before, docs)
    return out


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(stages, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "pii", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    for name, (_, after) in stages.items():
        assert name == "packing" or after.dtypes == columns


def test_quality(stages, spark):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(before, labels)
    kept = {i for i, r in _rows(before).items() if model.score(r["text"]) >= 0.5}
    assert _rows(after).keys() == kept and len(kept) < before.count()
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    right = [(i in kept) == (q == 1) for i, q in marks.items()]
    assert np.mean(right) >= 0.97


def test_exact(stages):
    before, after = stages["exact_dedup"]
    least = {}
    for i, r in _rows(before).items():
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        least[text] = min(i, least.get(text, i))
    assert _rows(after).keys() == set(least.values())
    assert all(_rows(before)[i] == r for i, r in _rows(after).items())


def test_simhash(stages):
    before, after = stages["simhash"]
    component = components_of({i: simhash_print(r["text"]) for i, r in _rows(before).items()}, 2)
    assert _rows(after).keys() == set(component.values())


def test_pii(stages):
    before, after = stages["pii"]
    found = _rows(pii.find(before))
    changed = 0
    for i, r in _rows(after).items():
        text, own = _rows(before)[i]["text"], found[i]["found"]
        for f in sorted(own, key=lambda f: -f["start"]):
            text = text[:f["start"]] + f"[{f['kind'].upper()}]" + text[f["end"]:]
        own.sort(key=lambda f: f["start"])
        overlap = any(a["end"] > b["start"] for a, b in zip(own, own[1:]))
        assert overlap or (r["text"], r["n_chars"]) == (text, len(text))
        changed += bool(own)
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"])
    assert changed


def test_packing(stages):
    before, after = stages["packing"]
    tokenizer = packing.encoder(packing.default_tokenizer()).tokenizer
    pieces = defaultdict(list)
    for r in after.collect():
        pieces[r["doc_id"]].append(r)
    for i, r in _rows(before).items():
        own = sorted(pieces[i], key=lambda p: p["start"])
        ids = [x for p in own for x in np.frombuffer(bytes(p["ids"]), "<u4").tolist()]
        assert ids == tokenizer.encode(r["text"], add_special_tokens=False).ids + [2]


def test_run_is_the_stages(stages, spark):
    again = corpus_pipeline.run(spark, SF).groupBy("doc_id").sum("length").collect()
    once = stages["packing"][1].groupBy("doc_id").sum("length").collect()
    assert sorted(again) == sorted(once)
    assert corpus_pipeline.oracle_sql() == {}
