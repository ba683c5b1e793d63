"""Lattice encoding: the library's ids, exact round trip, Viterbi against all paths."""

import random

import numpy as np
import pytest
import sentencepiece

from ledgerflow.llm import sentencepiece_lattice as sl

TEXTS = [
    None, "", " ", "Hello  world", "  two lead", " a\nb\tc", "é漢字 x", "x" * 300, "the  ", "\x00a", "ﬁ　x", "<s> a </s> <unk>", "<0x41>",
    "don't, 'stop' (now)!! can't... a,'b ,'abc it's", "THE!! AND!! OF!!", "the*** of%%% and&&& 123.45 $$$x x$$$ a_b __init__",
    "日本語のテキストは空白がない。" * 20, "😀👩‍👩‍👧 é é", "a" * 61 + " " + "ab" * 200, "word\n\n\n  next\r\nline", "https://www.example.com/path?x=1&y=2#z",
    "if (x == 0) { return \"a\\n\"; }  // ok", " " * 40 + "deep", "the quick brown fox " * 50,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    alphabet = "aaeeiinnrrsstt  ..,'\"!*éñ\n-(1"
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(60)]


@pytest.mark.parametrize("hot", [0, 60, 4_000_000])
def test_ids_are_the_librarys(spark, texts, hot):
    rows = [(i if i else None, t, 1, "w") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, word string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=sl.default_model())
    got = {r["doc_id"]: r for r in sl.encode(docs, hot=hot).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        assert np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist() == library.encode(t or ""), t
        assert got[i]["decoded"] == (t or "")


def test_broadcast_is_bounded_in_bytes(spark, texts):
    """What no longer fits comes back by the join, with the same ids."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = sl.pieces(sl.default_model())
    words = sl.count_words(docs, lambda: sl.pieces(sl.default_model())).where(f"length(word) <= {sl.LONGEST}").cache()
    known = sl.encode_words(words.select("word"), table).cache()
    for most in (0, 500, 3000, 1 << 20):
        own = sl.hot_words(words, known, 1_000_000, most)
        sent = len(own.blob) + own.hashes.nbytes + own.checks.nbytes + own.place.nbytes - 4
        assert sent <= most and (own.size > 0) == (most > 0)
    assert own.size == words.count()
    ids = {r["word"]: np.array(r["ids"], "<u4").tobytes() for r in known.collect()}
    assert all(own.get(w) == packed for w, packed in ids.items())
    library = sentencepiece.SentencePieceProcessor(model_file=sl.default_model())
    for r in sl.encode(docs, hot_bytes=3000).collect():
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode(texts[r["doc_id"]] or "")


def test_words_join_to_the_text(texts):
    table = sl.pieces(sl.default_model())
    for t in texts:
        if t:
            words = table.split(t)
            assert "".join(words) == sl.SPACE + t.replace(" ", sl.SPACE)
            for a, b in zip(words, words[1:]):
                assert (a[-1], b[0]) not in table.inside
            for w in words:
                parts = table.parts(w)
                assert "".join(parts) == w and all(pair in table.inside for p in parts for pair in zip(p, p[1:]))


def test_chunks_hold_the_runs(texts):
    table = sl.pieces(sl.default_model())
    for t in [*texts, "foo\u2581 bar", "\u2581", " \u2581 a", "a \n b", "tail ", "a\u2581b c", "x \n"]:
        if t:
            assert [r for c in table.chunks(t) for r in table.runs_of(c)] == table.split(t)


def test_many_texts_are_cut_as_one_by_one(texts):
    rng = random.Random(2)
    found = [None, "", *texts, *("".join(rng.choice("aae  .,'!*é\n-(\u2581漢😀") for _ in range(rng.randint(0, 30))) for _ in range(2000))]
    small = [["ab", "a\n", "\u2581a", "!a"], ["a", "ab", "a\u2581b", "!!"], ["a!", "!!", "..", "é,", "\u2581\u2581"]]
    tables = [sl.Pieces(None, tuple((p, n + 1, -float(n)) for n, p in enumerate(ps)), (), 0, True) for ps in small]
    for table in [sl.pieces(sl.default_model()), *tables]:
        cut = table.cutter.cut(found)
        for i, t in enumerate(found):
            runs = table.split(t or "")
            assert cut.n_runs[i] == len(runs), t
            assert [cut.word(w) for w in range(cut.bounds[i], cut.bounds[i + 1])] == [p for r in runs for p in table.parts(r)], t


def test_words_are_found_by_their_hashes():
    rng = random.Random(5)
    words = list({"".join(rng.choice("abcdé漢😀") for _ in range(rng.randint(1, 60))) for _ in range(5000)} | {"a", "b"})
    cut = sl.pieces(sl.default_model()).cutter.cut([" ".join(words)])
    hashes, checks = sl.word_hashes(cut.points, cut.starts, cut.ends)
    alone = [sl._hashes_of([cut.word(w)]) for w in range(0, len(cut.starts), 50)]
    assert [(int(h[0]), int(c[0])) for h, c in alone] == list(zip(hashes[::50].tolist(), checks[::50].tolist()))
    own = sl.HotWords.sorted(*sl._hashes_of(words[:3000]), np.arange(6000, dtype="<u2"), np.arange(0, 6001, 2))
    assert [own.get(w) for w in words] == [np.array([2 * n, 2 * n + 1], "<u4").tobytes() if n < 3000 else None for n in range(len(words))]


@pytest.mark.parametrize("share", [1, 3])
def test_few_bytes_are_shuffled(spark, share):
    """Words at hand, words counted but not at hand and words not counted; the words that come
    back to their documents travel as hashes, with narrow ids."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 8))) for _ in range(60)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=sl.default_model())
    out = sl.encode(docs, hot_bytes=3000, share=share)
    for r in out.collect():
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode(texts[r["doc_id"]])
        assert r["decoded"] == texts[r["doc_id"]] and r["n_runs"] == len(sl.pieces(sl.default_model()).split(texts[r["doc_id"]]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "as smallint" in plan and not [p for p in plan.splitlines() if "collect_list" in p and "struct(word" in p]


def test_texts_are_cut_once_for_their_ids(spark, texts, tmp_path):
    """Documents whose words are not broadcast are not cut again, and their texts not moved."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = sl.encode(docs, hot=60).select("doc_id", "ids")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    passes = [line for line in plan.splitlines() if "ReusedExchange" not in line and "seat" in line and "missing" in line and "MapInArrow" in line]
    assert "ReusedExchange" in plan
    assert len([line for line in passes if "packed" in line and "own_seat" not in line.split("], [")[-1]]) == 1
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "text" in line]


def test_late_pieces_and_many_joins(spark):
    """A random BPE table: the fold's rounds against joining the best edge, one at a time."""
    rng = random.Random(3)
    found = list({"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(60)} | {"a", "b", "c"})
    rng.shuffle(found)
    table = sl.Pieces(None, tuple((p, n + 1, -float(n // 2)) for n, p in enumerate(found)), (), 0, True)
    score, ids = {p: s for p, _, s in table.pieces}, {p: i for p, i, _ in table.pieces}
    words = sorted({"".join(rng.choice("abcz") for _ in range(rng.randint(1, 40))) for _ in range(200)} | {"a" * 60, "abc" * 20})
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(3, "word")
    assert table.late
    for r in sl.encode_words(frame, table).collect():
        parts = list(r["word"])
        while best := max(((score[a + b], -n) for n, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score), default=None):
            n = -best[1]
            parts[n:n + 2] = [parts[n] + parts[n + 1]]
        assert [*r["ids"]] == [ids.get(p, 0) for p in parts], r["word"]


def _paths(word, table):
    """All segmentations with their scores; unknown characters as single steps."""
    known = {p: (i, s) for p, i, s in table.pieces}
    low = min(s for _, s in known.values()) - 10.0
    out = [(0.0, [])] if not word else []
    for n in range(1, len(word) + 1):
        i, s = known.get(word[:n], (None, low))
        if i is not None or n == 1:
            out += [(s + total, [table.unknown if i is None else i, *ids]) for total, ids in _paths(word[n:], table)]
    return out


def test_viterbi_against_all_paths(spark):
    rng = random.Random(9)
    found = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} | {"a", "b"}
    table = sl.Pieces(None, tuple((p, n + 1, -rng.uniform(1, 9) * len(p) ** 0.5) for n, p in enumerate(sorted(found))), (), 0, False)
    words = sorted({"".join(rng.choice("abcz") for _ in range(rng.randint(1, 9))) for _ in range(60)})
    score = {i: s for _, i, s in table.pieces} | {0: min(s for _, _, s in table.pieces) - 10.0}
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(3, "word")
    got = {r["word"]: r["ids"] for r in sl.encode_words(frame, table).collect()}
    assert got.keys() == set(words)
    for w in words:
        best = max(s for s, _ in _paths(w, table))
        assert [*got[w]] in [ids for _, ids in _paths(w, table)]
        assert sum(score[i] for i in got[w]) == pytest.approx(best)


def test_awkward_rows(spark):
    rows = [(1, "same text"), (1, "same text"), (2, None), (None, "x"), (None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["decoded"]) for r in sl.encode(docs, hot=0).collect())
    assert got == [(-1, "x"), (-1, "y"), (1, "same text"), (1, "same text"), (2, "")]
    assert sl.encode(docs.limit(0)).count() == 0
