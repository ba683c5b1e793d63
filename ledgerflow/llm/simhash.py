"""SimHash near-dedup: 64-bit fingerprints and a binary trie self-join.

*Fingerprints*: lower-cased (A-Z) texts, word shingles, XXH64 (seed 42) of each, and for
each of the 64 bits the strict majority over all shingles, repeats included.

*Trie self-join*: fingerprints at most ``bits`` apart agree on one of ``bits + 1`` blocks.
For every block the fingerprints are rotated so that the block leads and put into a binary
trie; the trie is entered at the nodes below that block, and node pairs are walked together
one bit at a time, adding a differing bit where the branches differ and dropping a pair as
soon as the budget is exceeded. The nodes of many blocks are walked at once as sorted
ranges. A block with more than ``split`` distinct fingerprints is first taken apart into
the node pairs some bits below it, each its own unit of work, so no block is one task's.

Only distinct fingerprints are joined: a thousand copies are one leaf. Links go to
:func:`components.connected_components`.

Defined results: a text without words (NULL, empty, white space) has fingerprint zero, which
links like any other; with fewer words than a shingle, the whole sequence is the only one;
rows that repeat an id are returned each; a NULL id is never a component's name unless the
component has no other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.components import connected_components
from ledgerflow.llm.rows import id_and_bytes, map_rows
from ledgerflow.session import materialize

SHINGLE, BITS, SEED = 3, 2, 42
SPLIT = 50_000  # distinct fingerprints below one block that stay one unit of work
PAIRS = 1 << 20  # node pairs walked at once
_AT_ONCE = 1 << 15  # shingles whose bits are added up at once

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        a, b = starts[at:min(at + _AT_ONCE, n)], ends[at:min(at + _AT_ONCE, n)]
        h = np.fromiter((digest(line[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())), np.uint64, len(a))
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(set_in * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per input row; fp is the unsigned fingerprint's bits as a long."""

    def signed(i, t: bytes) -> tuple:
        fp = fingerprint(t, shingle)
        return i, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(id_and_bytes(docs, text, key), lambda: signed, "id long, fp long")


def blocks(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``bits + 1`` blocks that share out the 64 bits."""
    edge = [round(64 * i / (bits + 1)) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(edge, edge[1:])]


def _masks(width: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(width), n)]


def walk(values: np.ndarray, a0, a1, b0, b1, errors, depth, bits: int) -> Iterator[np.ndarray]:
    """Pairs (as rows of two values) at most ``bits`` apart below the given node pairs.

    ``values``: sorted uint64, distinct within a node; a node is a range of it. ``depth``:
    bits above the node. Equal nodes mean pairs inside one node."""
    stack = [tuple(np.asarray(x, np.int64) for x in (a0, a1, b0, b1, errors, depth))]
    while stack:
        a0, a1, b0, b1, e, d = stack.pop()
        if len(a0) > PAIRS:
            half = len(a0) // 2
            stack += [tuple(x[half:] for x in (a0, a1, b0, b1, e, d))]
            a0, a1, b0, b1, e, d = (x[:half] for x in (a0, a1, b0, b1, e, d))
        same = a0 == b0
        live = (a1 > a0) & (b1 > b0) & (e <= bits) & ~(same & (a1 - a0 < 2))
        leaf = live & (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():  # one value each: their remaining bits are compared at once
            x, y = values[a0[leaf]], values[b0[leaf]]
            near = np.bitwise_count(x ^ y) <= bits
            if near.any():
                yield np.stack([x[near], y[near]], axis=1)
        live &= ~leaf
        if not live.any():
            continue
        a0, a1, b0, b1, e, d, same = (x[live] for x in (a0, a1, b0, b1, e, d, same))
        am, bm = _middle(values, a0, a1, d), _middle(values, b0, b1, d)
        d = d + 1
        cross = ~same
        stack.append(tuple(np.concatenate(x) for x in zip(
            (a0, am, b0, bm, e, d),
            (am, a1, bm, b1, e, d),
            (a0, am, bm, b1, e + 1, d),
            (am[cross], a1[cross], b0[cross], bm[cross], e[cross] + 1, d[cross]),
        )))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where, in each range, the bit below ``depth`` turns from 0 to 1 (binary search)."""
    lo, hi, shift = lo.copy(), hi.copy(), (63 - depth).astype(np.uint64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = (values[np.minimum(mid, len(values) - 1)] >> shift) & np.uint64(1) == 1
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _join_units(bits: int):
    """All units of a partition at once: a unit is a block's trie (low = high = -1) or the
    pair of its nodes low and high, ``deep`` bits below the block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        del held
        value = rows["turned"].to_numpy(np.int64).view(np.uint64)
        width, shift, deep, low, high = (rows[c].to_numpy(np.int64) for c in ("width", "shift", "deep", "low", "high"))
        block = value >> (64 - width).astype(np.uint64)
        by = np.lexsort((value, high, low, block, shift))
        value, width, shift, deep, low, high, block = (x[by] for x in (value, width, shift, deep, low, high, block))
        new = np.ones(len(value), bool)
        new[1:] = (shift[1:] != shift[:-1]) | (block[1:] != block[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(value))
        width, shift, deep, low, high = (x[start] for x in (width, shift, deep, low, high))
        two = low != high  # low < high are the two nodes, next to each other in the order
        depth = width + deep
        below = np.array([int(h) if t else 0 for h, t in zip(high, two)], np.int64)
        mid = end.copy()
        for u in np.flatnonzero(two):
            node = (value[start[u]:end[u]] >> np.uint64(64 - depth[u])) & np.uint64((1 << int(deep[u])) - 1)
            mid[u] = start[u] + np.searchsorted(node, np.uint64(below[u]))
        a0, a1 = start, np.where(two, mid, end)
        b0, b1 = np.where(two, mid, start), end
        errors = np.where(two, np.bitwise_count((low ^ high).astype(np.uint64)), 0)
        for turn in np.unique(shift):
            own = shift == turn
            back = np.uint64(turn)
            for pairs in walk(value, a0[own], a1[own], b0[own], b1[own], errors[own], depth[own], bits):
                pairs = (pairs >> back) | (pairs << ((np.uint64(64) - back) & np.uint64(63))) if turn else pairs
                yield pd.DataFrame(np.ascontiguousarray(pairs).view(np.int64), columns=["a", "b"])

    return run


def trie_join(prints: DataFrame, bits: int = BITS, split: int = SPLIT) -> DataFrame:
    """(a, b), a < b: all links between different values of the long column ``fp``."""
    distinct = prints.select("fp").where("fp is not null").distinct()
    turned = None
    for first, width in blocks(bits):
        left = F.shiftleft("fp", first)
        value = left.bitwiseOR(F.shiftrightunsigned("fp", 64 - first)) if first else F.col("fp")
        one = distinct.select(value.alias("turned"), F.lit(first).alias("shift"), F.lit(width).alias("width"),
                              F.shiftrightunsigned(value, 64 - width).alias("block"))
        turned = one if turned is None else turned.union(one)
    turned = materialize(turned, "trie-leaves")
    # a partial-aggregate count; one row per block that has several leaves
    sizes = turned.groupBy("shift", "block").count().where("count > 1").withColumn(
        "deep", F.when(F.col("count") <= split, 0).otherwise(
            F.least(F.lit(16), F.ceil(F.log2(F.col("count") / split)) + 2)).cast("int")).drop("count")
    units = turned.join(sizes, ["shift", "block"])
    whole = units.where("deep = 0").withColumns({"low": F.lit(-1).cast("long"), "high": F.lit(-1).cast("long")})
    masks = distinct.sparkSession.createDataFrame(
        [(deep, m) for deep in range(1, 17) for m in _masks(deep, bits)], "deep int, mask long")
    node = F.expr("shiftrightunsigned(shiftleft(turned, width), 64 - deep)")
    taken = units.where("deep > 0").join(F.broadcast(masks), "deep").withColumn("node", node)
    taken = taken.withColumns({
        "low": F.least("node", F.col("node").bitwiseXOR(F.col("mask"))),
        "high": F.greatest("node", F.col("node").bitwiseXOR(F.col("mask"))),
    }).select(whole.columns)
    links = whole.unionByName(taken).select("shift", "block", "turned", "width", "deep", "low", "high").repartition(
        "shift", "block", "low", "high").mapInPandas(_join_units(bits), "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                bits: int = BITS, split: int = SPLIT) -> DataFrame:
    """One row per input row: the id, the fingerprint as 16 hex digits, component_id."""
    prints = materialize(fingerprints(docs, text, key, shingle), "simhash")
    links = trie_join(prints, bits, split)
    roots = connected_components(links)
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.select("fp", "root").join(names, "root").select(F.col("fp").alias("print"), "component_id")
    return prints.join(by_print, prints["fp"] == by_print["print"]).select(
        F.col("id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that name their group, all columns unchanged; rows without an id
    stay, and so do all rows that repeat a staying id."""
    groups = near_groups(docs, text, key, shingle, bits)
    gone = groups.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
