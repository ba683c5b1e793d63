"""Substring dedup: Rabin-Karp hashes of every window of ``WINDOW`` words.

Words are runs without ASCII white space, unchanged. A window is removed when its word
sequence also starts in a document with a smaller id; removed windows that touch or overlap
merge into maximal intervals. Windows are judged on the input, not on what is left.

1. Each task rolls two polynomial hashes over its documents' words and sorts the windows of
   about ``CHUNK`` words at a time. Of equal windows in a chunk only the smallest id goes
   on; the others are flagged at once. A passage that a third of all documents share thus
   reaches its bucket once per chunk, not once per document.
2. Windows go, packed per (chunk, bucket), to the bucket named by the second hash; the
   bucket finds each window's smallest id and flags the other holders. The number of
   buckets follows the text volume, so a bucket's size does not grow with the corpus.
3. Flags return to their documents, which roll the hashes again, merge the flagged windows
   and drop the covered words.

Two windows are taken as equal when the 64-bit first hash and the bucket number of the
second agree (70 bits at 64 buckets; a million buckets make it 84): chance equality is
about windows^2 / 2^(65 + log2 buckets).

Defined results: NULL and empty texts have no words and no windows; a document shorter than
a window keeps all; a window repeated only inside its own document stays; rows that repeat
an id count as one document and are all returned; a row without an id is returned whole and
is nobody's earlier source; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.rows import id_and_bytes, map_rows, map_stream

WINDOW = 13
CHUNK = 1 << 20  # words whose windows a task sorts at once
BUCKET_BYTES = 16 << 20  # text bytes per bucket
WORDS_KEPT = 300_000  # word hashes a worker remembers

_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()


def _tokens(words: list[bytes]) -> np.ndarray:
    if len(_words) > WORDS_KEPT:
        _words.clear()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _rolled(tokens: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """The polynomial hash, modulo 2^64, of the window that starts at each word."""
    n = max(0, len(tokens) - size + 1)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h *= base
        h += tokens[j:j + n]
    return h ^ (h >> np.uint64(29))


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: sorted or small numbers then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _per_document(ids: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(ids, kind="stable")
    ids, hashes = ids[order], hashes[order]
    cuts = np.flatnonzero(np.diff(ids)) + 1
    for at, to in zip([0, *cuts], [*cuts, len(ids)]):
        yield int(ids[at]), np.unique(hashes[at:to]).tobytes()


def _chunk(ids: list[int], tokens: list[np.ndarray], size: int, buckets: int) -> list[tuple]:
    """(bucket, id, hashes, holders): flags of this chunk (holders empty), and for each
    bucket the windows with, packed, the smallest id that holds each."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    doc_ids, rank = np.unique(np.array([ids[i] for i in order], np.int64), return_inverse=True)
    flat = np.concatenate([tokens[i] for i in order])
    doc = np.repeat(np.arange(len(order), dtype=np.uint32), [len(tokens[i]) for i in order])
    if len(flat) < size:
        return []
    inside = doc[:len(doc) - size + 1] == doc[size - 1:]
    doc = rank.astype(np.uint32)[doc[:len(inside)][inside]]
    h = _rolled(flat, size, _B1)[inside]
    bucket = (_rolled(flat, size, _B2)[inside] % np.uint64(buckets)).astype(np.uint32)
    if not len(h):
        return []
    by = np.argsort(h)
    h, doc, bucket = h[by], doc[by], bucket[by]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    least = np.minimum.reduceat(doc, first)
    later = doc > np.repeat(least, np.diff(np.append(first, len(h))))
    flags = _per_document(doc_ids[doc[later]], h[later]) if later.any() else ()
    out = [(n % buckets, i, x, b"") for n, (i, x) in enumerate(flags)]  # pass through any bucket
    h, bucket = h[first], bucket[first]
    by = np.argsort(bucket, kind="stable")  # hashes stay sorted within a bucket
    h, least, bucket = h[by], least[by], bucket[by]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for at, to in zip([0, *cuts], [*cuts, len(h)]):
        own, index = np.unique(least[at:to], return_inverse=True)
        wide = np.uint16 if len(own) <= 1 << 16 else np.uint32
        head = len(own).to_bytes(4, "little") + np.dtype(wide).itemsize.to_bytes(1, "little")
        out.append((int(bucket[at]), 0, _planes(h[at:to]),
                    head + _planes(doc_ids[own]) + _planes(index.astype(wide))))
    return out


def _windows(size: int, buckets: int):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        ids, tokens, held = [], [], 0
        for i, text in rows:
            words = text.split()
            if len(words) < size:
                continue
            ids.append(i)
            tokens.append(_tokens(words))
            held += len(words)
            if held >= CHUNK:
                yield _chunk(ids, tokens, size, buckets)
                ids, tokens, held = [], [], 0
        if ids:
            yield _chunk(ids, tokens, size, buckets)

    return run


def _repeats(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: (id, hash) of the flags made by its chunks, and of those it adds."""
    local = group["holders"].str.len() == 0
    own = [np.frombuffer(h, np.uint64) for h in group.loc[local, "hashes"]]
    flagged = [(np.repeat(group.loc[local, "id"].to_numpy(np.int64), [len(h) for h in own]), np.concatenate(own))] if own else []
    hashes, ids = [], []
    for h, holders in group.loc[~local, ["hashes", "holders"]].itertuples(index=False):
        n, wide = int.from_bytes(holders[:4], "little"), holders[4]
        own = _from_planes(holders[5:5 + 8 * n], np.int64)
        hashes.append(_from_planes(h, np.uint64))
        ids.append(own[_from_planes(holders[5 + 8 * n:], np.uint16 if wide == 2 else np.uint32)])
    if hashes:
        h, doc = np.concatenate(hashes), np.concatenate(ids)
        del hashes, ids
        by = np.argsort(h)
        h, doc = h[by], doc[by]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        later = doc > np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(h))))
        h, doc = h[later], doc[later]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        flagged.append((doc[new], h[new]))
    ids, hashes = (np.concatenate(x) for x in zip(*flagged))
    return pd.DataFrame({"id": ids, "hash": hashes.view(np.int64)})


def _kept(size: int):
    def one(i, text: bytes, flags) -> tuple:
        words = text.split()
        starts, ends = [], []
        if flags and len(words) >= size:
            flagged = np.array(flags, np.int64).view(np.uint64)
            hit = np.flatnonzero(np.isin(_rolled(_tokens(words), size, _B1), flagged))
            edge = np.zeros(len(words) + 1, np.int32)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + size, -1)
            covered = np.cumsum(edge[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
            starts, ends = turn[::2].tolist(), turn[1::2].tolist()
        n, kept = len(words), words
        if starts:
            kept = [w for a, b in zip([0, *ends], [*starts, n]) for w in words[a:b]]
        return i, n, n - len(kept), starts, ends, b" ".join(kept)

    return one


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """One row per input row: the id, n_words, n_removed, the removed word intervals
    (``removed_from`` inclusive, ``removed_to`` exclusive) and the kept words in one line."""
    spark = docs.sparkSession
    rows = id_and_bytes(docs, text, key)
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // BUCKET_BYTES))
    windows = map_stream(rows.where("id is not null"), _windows(size, buckets),
                         "bucket int, id long, hashes binary, holders binary")
    flags = windows.groupBy("bucket").applyInPandas(_repeats, "id long, hash long")
    flags = flags.groupBy(F.col("id").alias("flag_id")).agg(F.collect_list("hash").alias("flags"))
    joined = rows.join(flags, rows["id"] == flags["flag_id"], "left").select("id", "text", "flags")
    out = map_rows(joined, lambda: _kept(size), "id long, n_words long, n_removed long, "
                   "removed_from array<int>, removed_to array<int>, kept_text binary")
    return out.withColumn("kept_text", F.col("kept_text").cast("string")).withColumnRenamed("id", key)
