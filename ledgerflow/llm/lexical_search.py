"""Ranked lexical search over hashed max-sketches.

Terms are runs of ASCII letters, digits and all characters from U+0080 on, A-Z lower-cased.
With N documents that hold a term, L terms in all, n in this document, df documents that
hold the term and tf places of it here,

    weight of a term    w = floor(1000 ln((2 N + 2) / (2 df + 1)))
    impact here         i = 1000000000 tf div (1000 tf + 20 m),  m = 50 + 50 n N div L

and a document's score is the sum of w i over the item's different terms.

1. *Index* (:func:`build_index`, any number of searches use it): a document's sketch folds
   its terms into ``WIDTH`` hashed coordinates, each with the largest tf that falls on it.
   Within a document the impact grows with tf alone, so that maximum is the coordinatewise
   maximum of the impacts, whatever N and L will be. Each task adds up its documents' df.
2. *Bounds*: items come in blocks; each task looks up a block's coordinates in its sketches.
   The sum of w times the coordinate's impact is at least the score. Each item's candidates
   are taken in descending bound, ``FIRST`` in the first round and ``GROWTH`` times more in
   each one after it.
3. *Rescoring*: the texts of the candidates alone are read and scored exactly. The k-th best
   score is the item's threshold; only documents whose bound reaches it go into the next
   round. An item is done when no such document is left, so results are exact and no
   number of candidates is a cap.

The driver holds one block: at most ``PAIRS`` pairs of item and term (or one item), and for
each item its threshold. Candidates are broadcast up to ``BROADCAST`` ids, and joined beyond.

Defined results: a NULL or empty text has no term and is in neither N nor L; an item without
known terms gives no rows; equal scores rank by ascending id; rows that repeat an id count
as documents each, and the id is listed once with the best of their scores; rows without an
id are counted and not listed; rows that repeat an item are answered each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.rows import id_and_bytes, in_lists, map_stream
from ledgerflow.llm.words import WordHashes, from_narrow, narrow
from ledgerflow.session import materialize, scratch_path

WIDTH = 1 << 16  # coordinates of a sketch
TOP = 50
FIRST, GROWTH = 64, 16  # candidates of an item in the first round, and how many times more in the next
ITEMS, PAIRS = 256, 1 << 16  # items, and pairs of item and term, searched together
BROADCAST = 200_000  # candidate ids
TERMS_HELD = 500_000  # terms whose df a task adds up before it gives them out
DOCS_AT_ONCE = 1024
SALTS = 64

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_words = WordHashes(500_000)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return text.translate(_LETTERS).split()


def impact(tf, n, documents: int, total: int):
    """Integer impact of ``tf`` places in a document of ``n`` terms (numbers or arrays)."""
    m = 50 + 50 * n * documents // total
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def sketch(counts: Counter, width: int = WIDTH) -> tuple[bytes, bytes]:
    """Coordinates (sorted, 16 bits) and the largest tf on each."""
    at = (_words.of(list(counts)) % np.uint64(width)).astype(np.uint16)
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    order = np.argsort(at, kind="stable")
    at, tf = at[order], tf[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first].tobytes(), narrow(np.maximum.reduceat(tf, first))


def _index(width: int):
    """Rows (part, id, n, coordinates, peaks, term, df): a sketch per document, and df counts."""

    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        holding: Counter = Counter()

        def counted() -> Iterator[tuple]:
            for term, df in holding.items():
                yield "terms", None, None, None, None, term, df
            holding.clear()

        def out():
            for i, text in rows:
                found = Counter(terms(text))
                if not found:
                    continue
                holding.update(found.keys())
                yield ("sketches", i, sum(found.values()), *sketch(found, width), None, None)
                if len(holding) > TERMS_HELD:
                    yield from counted()
            yield from counted()

        return in_lists(out())

    return run


class Index:
    """The written sketches and df counts of a table of documents."""

    def __init__(self, spark: SparkSession, path: str, width: int = WIDTH):
        self.width = width
        table = spark.read.schema(
            "id long, n long, coordinates binary, peaks binary, term binary, df long, part string").parquet(path)
        self.sketches = table.where("part = 'sketches'").select("id", "n", "coordinates", "peaks")
        self.terms = table.where("part = 'terms'").select("term", "df")
        self.documents, self.total = self.sketches.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None,
                width: int = WIDTH) -> Index:
    """Reads the documents once and writes their index, under the checkpoint folder by default;
    ``width``: at most 65,536."""
    path = path or scratch_path(docs.sparkSession, "lexical-index")
    rows = map_stream(id_and_bytes(docs, text, key), _index(width),
                      "part string, id long, n long, coordinates binary, peaks binary, term binary, df long")
    rows.write.partitionBy("part").parquet(path)
    return Index(docs.sparkSession, path, width)


class _Block:
    """Items searched together: their weighted terms, and by coordinate the items that want it."""

    def __init__(self, items: list[tuple], weight: dict[bytes, int], width: int):
        self.items = items  # (id, its different terms)
        self.weighted = [[(t, weight[t]) for t in own if weight.get(t)] for _, own in items]
        pairs = [(k, t, w) for k, own in enumerate(self.weighted) for t, w in own]
        at = (_words.of([t for _, t, _ in pairs]) % np.uint64(width)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        self.item = np.array([k for k, _, _ in pairs], np.int64)[order]
        self.weight = np.array([w for _, _, w in pairs], np.int64)[order]
        self.first = np.searchsorted(at[order], np.arange(width + 1))

    def bounds(self, docs: int, doc: np.ndarray, at: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """Upper bounds (documents x items) from the documents' coordinates."""
        wanted = self.first[at + 1] - self.first[at]
        doc, impacts, base = (np.repeat(x, wanted) for x in (doc, impacts, self.first[at]))
        place = base + np.arange(len(base)) - np.repeat(np.cumsum(wanted) - wanted, wanted)
        # sums below 2^53 are exact in doubles: 10^6 times a weight below 10^5, for 90,000 terms
        cell = doc * len(self.items) + self.item[place]
        return np.bincount(cell, (self.weight[place] * impacts).astype(np.float64),
                           docs * len(self.items)).reshape(docs, -1).astype(np.int64)

    def score(self, item: int, counts: Counter, n: int, documents: int, total: int) -> int:
        return sum(w * impact(counts[t], n, documents, total) for t, w in self.weighted[item] if t in counts)


class _Progress:
    """For each item of a block: whether it is done, how far its candidates were taken, and
    the last (score, id) of its best so far."""

    def __init__(self, items: int):
        self.open = np.ones(items, bool)
        self.reached = [(math.inf, -1)] * items  # (bound, id) of the last candidate
        self.threshold = [(0, -1)] * items  # a document must exceed it: greater score, or equal and lesser id

    def may_enter(self, item: int, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        last, last_id = self.reached[item]
        least, least_id = self.threshold[item]
        return (((bounds < last) | (bounds == last) & (ids > last_id))
                & ((bounds > least) | (bounds == least) & (ids < least_id) & (least > 0)))


def _candidates(block: _Block, progress: _Progress, most: int, documents: int, total: int):
    """Of the sketches of a task: for each open item the ``most`` greatest bounds."""

    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def take(held: list[tuple]) -> None:
            ids = np.array([r[0] for r in held], np.int64)
            n = np.array([r[1] for r in held], np.int64)
            sizes = np.array([len(r[2]) // 2 for r in held])
            doc = np.repeat(np.arange(len(held)), sizes)
            at = np.frombuffer(b"".join(r[2] for r in held), np.uint16).astype(np.int64)
            tf = np.concatenate([from_narrow(r[3]) for r in held]).astype(np.int64)
            use = block.first[at + 1] > block.first[at]
            doc, at, tf = doc[use], at[use], tf[use]
            bounds = block.bounds(len(held), doc, at, impact(tf, n[doc], documents, total))
            for k in np.flatnonzero(progress.open).tolist():
                keep = progress.may_enter(k, bounds[:, k], ids)
                if not keep.any():
                    continue
                b, i = bounds[keep, k], ids[keep]
                if k in best:
                    b, i = np.concatenate([best[k][0], b]), np.concatenate([best[k][1], i])
                if len(b) > most:
                    order = np.lexsort((i, -b))[:most]
                    b, i = b[order], i[order]
                best[k] = b, i

        held: list[tuple] = []
        for row in rows:
            held.append(row)
            if len(held) == DOCS_AT_ONCE:
                take(held)
                held = []
        if held:
            take(held)
        yield from in_lists((k, i, b) for k, (bounds, ids) in best.items() for b, i in zip(bounds.tolist(), ids.tolist()))

    return run


def _rescored(block: _Block, documents: int, total: int):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        def out():
            for i, text, wanted in rows:
                counts = Counter(terms(text))
                n = sum(counts.values())
                for k in wanted:
                    score = block.score(k, counts, n, documents, total) if n else 0
                    if score:
                        yield k, i, score

        return in_lists(out())

    return run


def _greatest(rows: DataFrame, by: str, most: int) -> DataFrame:
    """For each item the ``most`` rows with the greatest ``by`` (equal ones by id), numbered in
    ``place``; an item's rows are first thinned out in salted parts."""
    order = [F.col(by).desc(), F.col("id")]
    part = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = part.withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    part = part.where(F.col("place") <= most).drop("place", "salt")
    out = part.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return out.where(F.col("place") <= most)


def _search_block(index: Index, docs: DataFrame, block: _Block, k: int, first: int, growth: int,
                  broadcast: int) -> DataFrame | None:
    """(item, id, score, place): the best of each item of the block."""
    documents, total = index.documents, index.total
    progress, most, scored, best = _Progress(len(block.items)), max(first, k), None, None
    progress.open = np.array([bool(own) for own in block.weighted], bool)
    while progress.open.any():
        found = map_stream(index.sketches.where("id is not null"), _candidates(block, progress, most, documents, total),
                           "item int, id long, bound long")
        found = _greatest(found.groupBy("item", "id").agg(F.max("bound").alias("bound")), "bound", most)
        found = materialize(found, "lexical-candidates")
        last = {r["item"]: r for r in found.groupBy("item").agg(
            F.count("*").alias("n"), F.max_by(F.struct("bound", "id"), "place").alias("last")).collect()}
        for item in np.flatnonzero(progress.open).tolist():
            if item not in last or last[item]["n"] < most:
                progress.open[item] = False  # nothing beyond these can enter
            else:
                progress.reached[item] = (last[item]["last"]["bound"], last[item]["last"]["id"])
        if not last:
            break
        wanted = found.groupBy(F.col("id").alias("doc")).agg(F.sort_array(F.collect_list("item")).alias("wanted"))
        if sum(r["n"] for r in last.values()) <= broadcast:
            wanted = F.broadcast(wanted)
        texts = docs.join(wanted, docs["id"] == wanted["doc"]).select("id", "text", "wanted")
        new = materialize(map_stream(texts, _rescored(block, documents, total), "item int, id long, score long"), "lexical-scores")
        scored = new if scored is None else scored.unionByName(new)
        best = _greatest(scored.groupBy("item", "id").agg(F.max("score").alias("score")), "score", k)
        if progress.open.any():
            for r in best.where(F.col("place") == k).collect():
                progress.threshold[r["item"]] = (r["score"], r["id"])
        most *= growth
    return best


def _blocks(items: DataFrame, item: str, text: str, most: int, pairs_most: int) -> Iterator[list[tuple]]:
    """Items with their different terms, block by block."""
    rows = items.select(items[item].alias("item"), F.coalesce(items[text], F.lit("")).cast("binary").alias("text"))
    held, pairs = [], 0
    for row in rows.toLocalIterator():
        own = sorted(set(terms(bytes(row["text"]))))
        if held and (len(held) == most or pairs + len(own) > pairs_most):
            yield held
            held, pairs = [], 0
        held.append((row["item"], own))
        pairs += len(own)
    if held:
        yield held


def search(index: Index, docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", key: str = "doc_id",
           item: str = "item_id", item_text: str = "text", first: int = FIRST, growth: int = GROWTH,
           broadcast: int = BROADCAST, block: tuple[int, int] = (ITEMS, PAIRS)) -> DataFrame:
    """For each item its ``k`` best documents with a score above 0: the item's id, rank (from
    1), the document's id and the score. ``docs`` are the documents that were indexed.

    ``first``, ``growth``: candidates of a round; ``broadcast``: ids sent to all executors;
    ``block``: items, and pairs of item and term, searched together. None changes the result."""
    spark = docs.sparkSession
    rows = id_and_bytes(docs, text, key).where("id is not null")
    kind = items.schema[item].dataType.simpleString()
    out = spark.createDataFrame([], f"`{item}` {kind}, rank int, `{key}` long, score long")
    for own in _blocks(items, item, item_text, *block) if index.documents else ():
        known = spark.createDataFrame([(t,) for t in sorted({t for _, ts in own for t in ts})], "wanted binary")
        counted = index.terms.join(F.broadcast(known), F.col("term") == F.col("wanted")).groupBy("term").agg(F.sum("df").alias("df"))
        weight = {bytes(t): math.floor(1000 * math.log((2 * index.documents + 2) / (2 * df + 1))) for t, df in counted.collect()}
        best = _search_block(index, rows, _Block(own, weight, index.width), k, first, growth, broadcast)
        if best is None:
            continue
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(own)], f"item int, name {kind}")
        out = out.unionByName(best.join(F.broadcast(names), "item").select(
            F.col("name").alias(item), F.col("place").alias("rank"), F.col("id").alias(key), "score"))
    return out
