"""Periodic runs: maximal stretches of words that repeat with a period.

Words are runs without ASCII white space. A run has smallest period q (words q apart are
identical), at least ``LEAST`` words and two whole periods, and no neighbouring word extends
it. In a run the words that equal the word q later form a stretch of at least
max(q, LEAST - q) words, so at one dyadic scale that stretch holds a whole block:

1. At each scale (blocks of B = 4, 8, 16, ... words, one every B / 2) the periods from
   1.5 B - 1 to 3 B - 2 are searched (from 1 at the least scale). A block whose words do not
   all come again within that distance cannot match and is left out, and so is one that
   lies with its whole window in a run found before whose period is at most B (it could
   match at multiples of that period only).
2. *Block convolution*: the sum of squared differences between the block's word numbers and
   the following window, at every distance at once, is two running sums of squares and one
   correlation, computed by an integer number-theoretic transform (modulo 15 * 2^27 + 1).
   A sum that is not zero proves a mismatch; a zero is confirmed word by word, so results
   are exact.
3. *Seeds*: neighbouring blocks with one distance make a chain, which is extended to both
   sides while words agree. Of stretches with the same ends the smallest period stays.

Documents are searched together, about ``GROUP`` words at a time in the task that holds
them, parted by words that equal nothing; nothing is shuffled.

Defined results: a NULL or empty text has no words and no runs; rows that repeat an id are
searched each; a NULL id is like any other; a text of any length is searched whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.rows import id_and_bytes, map_stream

LEAST = 12
GROUP = 1 << 18  # words searched together
AT_ONCE = 1 << 19  # numbers in one transform of many blocks

PRIME, GENERATOR = 15 * (1 << 27) + 1, 31
_P = np.uint64(PRIME)
_FAR = np.iinfo(np.int64).max


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The powers below size / 2 of a root of unity of that order."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % _P])
    return out


def _forward(a: np.ndarray) -> np.ndarray:
    """Transform of every row, in the order that :func:`_backward` takes."""
    half = a.shape[1] // 2
    while half:
        pair = a.reshape(len(a), -1, 2, half)
        low, high = pair[:, :, 0], pair[:, :, 1]
        total = (low + high) % _P
        pair[:, :, 1] = (low + _P - high) * _roots(2 * half, False) % _P
        pair[:, :, 0] = total
        half //= 2
    return a


def _backward(a: np.ndarray) -> np.ndarray:
    size, half = a.shape[1], 1
    while half < size:
        pair = a.reshape(len(a), -1, 2, half)
        high = pair[:, :, 1] * _roots(2 * half, True) % _P
        low = pair[:, :, 0].copy()
        pair[:, :, 0] = (low + high) % _P
        pair[:, :, 1] = (low + _P - high) % _P
        half *= 2
    return a * np.uint64(pow(size, -1, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row and offset t the sum of (block[j] - window[t + j])^2, modulo the prime."""
    rows, b = blocks.shape
    w = windows.shape[1]
    size = 1 << (w - 1).bit_length()
    x, y = np.zeros((rows, size), np.uint64), np.zeros((rows, size), np.uint64)
    x[:, :b] = blocks[:, ::-1]
    y[:, :w] = windows
    product = _backward(_forward(x) * _forward(y) % _P)[:, b - 1:w]
    squares = np.zeros((rows, w + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % _P).sum(axis=1, dtype=np.uint64)[:, None]
    return (own + squares[:, b:] - squares[:, :-b] + np.uint64(2) * (_P - product)) % _P


def _gaps(words: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Distance to the same word's next place in its document."""
    order = np.argsort(words, kind="stable")
    after = np.full(len(words), _FAR, np.int64)
    same = words[order[1:]] == words[order[:-1]]
    here, there = order[:-1][same], order[1:][same]
    inside = there < end[here]
    after[here[inside]] = (there - here)[inside]
    return after


def _agree(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words in a row from ``at``, by steps of 1 or -1, equal the word ``distance`` later."""
    n, length = len(words), np.zeros(len(at), np.int64)
    open_, span = np.arange(len(at)), 8
    while len(open_):
        span = min(2 * span, max(16, AT_ONCE // len(open_)))
        for part in np.array_split(open_, -(-len(open_) * span // AT_ONCE)):
            place = (at[part] + step * length[part])[:, None] + step * np.arange(span)
            later = place + distance[part, None]
            same = (place >= 0) & (later < n)
            same &= words[np.clip(place, 0, n - 1)] == words[np.clip(later, 0, n - 1)]
            length[part] += np.where(same.all(axis=1), span, same.argmin(axis=1))
        # those that agreed over the whole span may go on
        last = at[open_] + step * (length[open_])
        ok = (last >= 0) & (last + distance[open_] < n)
        ok[ok] = words[last[ok]] == words[last[ok] + distance[open_[ok]]]
        open_ = open_[ok]
    return length


def _confirmed(words: np.ndarray, at: np.ndarray, distance: np.ndarray, block: int) -> np.ndarray:
    out = np.empty(len(at), bool)
    most = max(1, AT_ONCE // block)
    for lo in range(0, len(at), most):
        place = at[lo:lo + most, None] + np.arange(block)
        out[lo:lo + most] = (words[place] == words[place + distance[lo:lo + most, None]]).all(axis=1)
    return out


def _known(runs: list[np.ndarray], block: int, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether [at, to) lies in a run found before with a period of at most ``block``."""
    found = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
    found = found[found[:, 2] <= block]
    if not len(found):
        return np.zeros(len(at), bool)
    found = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(found[:, 0] + found[:, 1])
    last = np.searchsorted(found[:, 0], at, "right") - 1
    return (last >= 0) & (reach[last] >= to)


def search(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Runs (start, length, period), sorted. ``words``: numbers from 0; ``begin`` and ``end``
    of its document at each place. A word between two documents equals no other."""
    n = len(words)
    if n < LEAST:
        return np.empty((0, 3), np.int64)
    gaps = _gaps(words, end)
    longest = int((end - begin).max())
    runs: list[np.ndarray] = []
    block, lo, hi = 4, 1, 11
    padded = np.concatenate([words, np.zeros(4 * longest, np.int64)]).astype(np.uint64)
    widest = np.concatenate([gaps, np.full(-n % 2, _FAR)]).reshape(-1, 2).max(axis=1)  # of each half block
    while lo <= longest // 2 and len(widest) > 1:
        half = block // 2
        reach = np.maximum(widest[:-1], widest[1:])
        at = np.flatnonzero(reach < hi) * half
        at = at[at + block <= n]
        room = np.minimum(end[at] - at - block, (end[at] - begin[at]) // 2)  # largest distance that can matter
        at, room = at[room >= lo], room[room >= lo]
        fresh = ~_known(runs, block, at, np.minimum(at + hi - 1 + block, end[at]))
        at, room = at[fresh], room[fresh]
        most = max(1, AT_ONCE // (4 * block))
        seeds = []
        for first in range(0, len(at), most):
            own = at[first:first + most, None]
            zero = squared_differences(padded[own + np.arange(block)], padded[own + lo + np.arange(hi - 1 - lo + block)]) == 0
            row, offset = np.nonzero(zero & (lo + np.arange(zero.shape[1]) <= room[first:first + most, None]))
            seeds.append((own[row, 0], offset + lo))
        if seeds and (at := np.concatenate([s[0] for s in seeds])).size:
            distance = np.concatenate([s[1] for s in seeds])
            true = _confirmed(words, at, distance, block)
            at, distance = at[true], distance[true]
            order = np.lexsort((at, distance))
            at, distance = at[order], distance[order]
            new = np.ones(len(at), bool)
            new[1:] = (distance[1:] != distance[:-1]) | (at[1:] - at[:-1] != half)
            last = np.append(np.flatnonzero(new)[1:], len(at)) - 1 if len(at) else np.empty(0, np.int64)
            start, stop, distance = at[new], at[last] + block, distance[new]
            start = start - _agree(words, start - 1, distance, -1)
            stop = stop + _agree(words, stop, distance, 1)
            length = stop - start + distance
            good = (length >= 2 * distance) & (length >= LEAST)
            if good.any():
                runs.append(np.unique(np.stack([start, length, distance], axis=1)[good], axis=0))
        block *= 2
        lo, hi = 3 * block // 2 - 1, 3 * block - 1
        widest = np.concatenate([widest, np.full(-len(widest) % 2, _FAR)]).reshape(-1, 2).max(axis=1)
    if not runs:
        return np.empty((0, 3), np.int64)
    found = np.unique(np.concatenate(runs), axis=0)  # by start, length, period
    least = np.ones(len(found), bool)
    least[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[least]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start and period."""
    numbers = {w: k for k, w in enumerate(set().union(*texts))}
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = []
    for k, t in enumerate(texts):
        flat += map(numbers.__getitem__, t)
        flat.append(len(numbers) + k)  # parts this document from the next
    ends = np.cumsum(sizes + 1) - 1
    begin = np.repeat(ends - sizes, sizes + 1)
    found = search(np.array(flat, np.int64), begin, np.repeat(ends, sizes + 1))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(ends, found[:, 0])
    for k, (start, length, period) in zip(owner.tolist(), found.tolist()):
        out[k].append((start - int(ends[k] - sizes[k]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def _groups(size: int, change: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        ids, texts, held = [], [], 0

        def flush() -> list[tuple]:
            return [(i, len(words), found, b" ".join(collapse(words, found)))
                    for i, words, found in zip(ids, texts, runs_of(texts))]

        for i, text in rows:
            words = text.split()
            if change is not None:
                words = change(i, words)
            ids.append(i)
            texts.append(words)
            held += len(words) + 1
            if held >= size:
                yield flush()
                ids, texts, held = [], [], 0
        if ids:
            yield flush()

    return run


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id",
              change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per input row: the id, n_words, the runs (start and length in words, period; by
    start, then period) and the words that are left when each run keeps its first period, in
    one line. ``change`` gives the words to search, from the id and the text's words."""
    out = map_stream(id_and_bytes(docs, text, key), _groups(GROUP, change),
                     "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string")).withColumnRenamed("id", key)
