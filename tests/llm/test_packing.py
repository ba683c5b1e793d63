"""Packing: exact round trip of every id, full windows, balanced steps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import packing

ODD = [
    "İstanbul Ünï", "été ́x", "<|endoftext|>a <|startoftext|>", "don't they'll  x²½ 12ab", "a b\x85c\x1cd e　f",
    "日本語 テスト 한국어", "Σας ΟΔΟΣ", "x" * 3000, "", "\x00 \x00a", "😀 👩‍👩‍👧 é", "a\x0bb\x0cc", "ﬁ Å", "힣가 ᅡ",
]


@given(st.lists(st.integers(1, 400), max_size=60), st.booleans())
@settings(max_examples=80, deadline=None)
def test_pack(lengths, last):
    windows, left = packing.pack(lengths, (64, 32, 16), last)
    seen = defaultdict(list)
    for window, _, pieces in windows:
        assert window & (window - 1) == 0 and window == sum(n for _, _, n in pieces) <= 64
        for doc, start, n in pieces:
            seen[doc].append((start, n))
    for doc, start, n in left:
        seen[doc].append((start, n))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[doc]):
            assert start == at and n > 0
            at += n
        assert at == length
    assert sum(n for _, _, n in left) < 16
    assert not (last and left)


def test_chunks_encode_like_whole_texts():
    e = packing.ChunkEncoder(packing.default_tokenizer())
    rng = random.Random(2)
    latin = [chr(c) for c in range(0x20, 0x250) if c != 0x7F]
    texts = ["".join(rng.choice(latin) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    texts += ["".join(rng.choice("aBéÜ19.,!*$'<|>_ \n") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for text in ODD + texts:
        assert np.frombuffer(e.encode(text.encode()), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_chunks_skip_the_whole_tokenizer():
    """Their runs need neither normalizer nor splitter: the ids come from the model alone."""
    e = packing.ChunkEncoder(packing.default_tokenizer())
    whole = e.tokenizer

    class Watched:
        asked: list = []

        def encode(self, text, **kw):
            self.asked.append(text)
            return whole.encode(text, **kw)

        def encode_batch(self, texts, **kw):
            self.asked += texts
            return whole.encode_batch(texts, **kw)

    e.tokenizer = Watched()
    plain = "The quick, QUICK (brown) fox: \u00e9t\u00e9 \u00c9T\u00c9 stra\u00dfe 3.14 a1b2 --> x!? \u0141\u00f3d\u017a"
    for text in (plain, plain, "don't \u65e5\u672c <|endoftext|>"):
        assert np.frombuffer(e.encode(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert sorted(Watched.asked) == sorted("don't \u65e5\u672c <|endoftext|>".split())


@pytest.mark.parametrize("group", [200, 1 << 20])
def test_round_trip(spark, group):
    texts = [*ODD, None, *[" ".join(f"w{(i * j) % 997}" for j in range(i * 9 % 700)) for i in range(60)], "long " * 9000]
    rows = [(i if i else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, ids string").repartition(3)
    out = packing.pack_documents(docs, group=group).collect()
    tok = packing.encoder(packing.default_tokenizer()).tokenizer
    by_doc, by_sequence, steps = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"]
    for i, t, *_ in rows:
        want = tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in np.frombuffer(bytes(r["ids"]), "<u4").tolist()] == want
        assert {r["doc_tokens"] for r in pieces} == {len(want)}
    for rs in by_sequence.values():
        rs.sort(key=lambda r: r["offset"])
        at = 0
        for r in rs:
            assert r["offset"] == at
            at += r["length"]
        assert at == rs[0]["window"] <= 4096 and at & (at - 1) == 0
        steps[rs[0]["step_id"]] += at
    assert max(steps.values()) <= packing.STEP
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_steps_are_balanced(spark):
    docs = spark.createDataFrame([(i, "tok " * (i * 37 % 5000)) for i in range(400)], "doc_id long, text string").coalesce(1)
    out = packing.pack_documents(docs, with_ids=False)
    assert out.where("ids is not null").count() == 0
    per_step = [r["t"] for r in out.groupBy("step_id").sum("length").withColumnRenamed("sum(length)", "t").collect()]
    assert sum(t == packing.STEP for t in per_step) >= len(per_step) - 1
