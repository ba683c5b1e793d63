import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerflow.llm import periodic_runs, queries

FIELDS = "doc_id long, text string, runs int, collapsed int, id int, n_words int"


def brute(w):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_transform_counts_differences():
    rng = np.random.default_rng(0)
    blocks, windows = rng.integers(0, 50_000, (3, 16)), rng.integers(0, 50_000, (3, 55))
    windows[1, 7:23] = blocks[1]
    got = periodic_runs.squared_differences(blocks.astype(np.uint64), windows.astype(np.uint64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y[t:])) % periodic_runs.PRIME for t in range(40)]
            for x, y in zip(blocks, windows)]
    assert got.tolist() == want and got[1, 7] == 0


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for turn in range(250):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n = rng.randint(0, 500 if turn % 10 == 0 else 110)
            w = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
            for _ in range(rng.randint(0, 2) if n > 4 else 0):
                a, e = rng.randrange(n), rng.randint(0, n)
                p = rng.randint(1, max(1, (n - a) // 2))
                for i in range(a, e):
                    w[i] = w[a + (i - a) % p]
            docs.append(w)
        assert periodic_runs.runs_of(docs) == [brute(w) for w in docs]


def test_long_texts():
    one = [b"a"] * 300_000
    tail = [b"%d" % i for i in range(20_000)]
    assert periodic_runs.runs_of([one, tail + tail + tail[:5], tail]) == [[(0, 300_000, 1)], [(0, 40_005, 20_000)], []]


def test_query_equals_brute_force(spark, tmp_path):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:60]
    rows = [(r["doc_id"], r["text"], 1, 2, 3, 4) for r in docs]
    hot = [i for i in range(100_000, 100_200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows += [(i, " ".join(map(str, range(40 + i % 7))), 0, 0, 0, 0) for i in hot]
    rows += [(None, "a b " * 20, 1, 1, 1, 1), (7, None, 1, 1, 1, 1), (7, "", 1, 1, 1, 1), (7, " \t\r\n\x0b\x0c", 1, 1, 1, 1),
             (9, "x y " * 12, 1, 1, 1, 1), (9, "x y " * 12, 1, 1, 1, 1), (9, "x y " * 11, 1, 1, 1, 1)]
    spark.createDataFrame(rows, FIELDS).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    want = []
    for i, text, *_ in rows:
        words = queries.looped(i, (text or "").encode().split())
        runs = brute(words)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        gone = {p for s, n, q in runs for p in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        want.append((i, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[1] > 0 and r[0] in hot for r in got)


def test_planted_tail_follows_the_contract():
    i = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [b"%d" % n for n in range(97)]
    g = zlib.crc32(str(i).encode()) // 10
    a = g % 97
    p = 1 + (97 - a) // (3 + g % 8)
    assert queries.looped(i, words) == words[:a] + [words[a + (k - a) % p] for k in range(a, 97)]
    assert queries.looped(i, []) == [] and queries.looped(None, words) == words


@pytest.mark.parametrize("rows", [[], [(None, None, 0, 0, 0, 0)]])
def test_no_words(spark, rows):
    got = periodic_runs.find_runs(spark.createDataFrame(rows, FIELDS)).collect()
    assert [tuple(r) for r in got] == [(None, 0, [], "")] * len(rows)
