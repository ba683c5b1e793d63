"""Language-model scoring by deleted interpolation of n-gram estimates.

Tokens of a text are its words (runs without ASCII white space, A-Z lower-cased) and one end
token. A token's probability mixes the maximum-likelihood estimates of all orders:

    p(w | context) = l0 / (V + 1) + l1 c(w) / N + l2 c(v w) / c(v) + ...

The weights belong to buckets: the longest context that was seen in training, and the power
of two of its count. One in ``DELETED`` training documents is kept out of the counts while
expectation-maximisation fits the weights to its tokens; the final counts hold it again.

1. *Chunks*: each task packs its documents into chunks of about ``CHUNK`` words, written as a
   table. Training documents that are kept out have chunks of their own.
2. *Counts*: each chunk sends its distinct n-grams (63-bit hashes; the last bit tells
   single words) with their counts, packed, to buckets by range of the hash. A bucket adds
   the counts of all chunks and answers each in the order in which it asked, so an n-gram
   that a third of all documents hold reaches its bucket once per chunk. No n-gram is
   dropped; buckets grow with the text.
3. *Weights*: chunks kept out look up their tokens' counts without their own part and add up
   cells of similar estimates (one octave wide; at most 48 x 41^n cells, whatever the
   corpus). Expectation-maximisation runs on the cells' means.
4. *Scores*: every chunk meets its answers and adds up its documents' logarithms.

Two n-grams are taken as equal when their hashes agree: the chance that any two of n
different ones do is about n^2 / 2^64.

Defined results: a NULL or empty text is the end token alone; rows that repeat an id are
read, learnt and scored each; a NULL id is like any other; without training documents all
counts are 0 and every token has probability 1; without kept-out tokens the weights are
equal; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.rows import map_stream
from ledgerflow.llm.words import WordHashes, from_narrow, from_planes, narrow, planes
from ledgerflow.session import materialize

ORDER = 2
CHUNK = 1 << 18  # words of a chunk
BUCKET_BYTES = 8 << 20  # text bytes per bucket of n-grams
DELETED = 16  # one in so many training documents fits the weights
BITS = 48  # buckets of context counts: their bit length
OCTAVES = 40  # estimates below 2^-40 share a cell
PRIOR = 20.0  # tokens that a bucket borrows from all buckets of its context length
LEAST = 1e-6  # no weight that a context can have is smaller
ROUNDS = 200

_BEGIN, _END = b" ", b"\n"  # no word holds white space
_FIXED = {_BEGIN: 0x9B05688C2B3E6C1F, _END: 0xBB67AE8584CAA73B}
_B = np.uint64(0x9E3779B97F4A7C15)

_words = WordHashes(200_000, _FIXED)

# ids and sizes are 64-bit; flags: 1 learnt, 2 the id is NULL; texts are compressed together
CHUNKS = "chunk long, deleted boolean, ids binary, flags binary, sizes binary, volume long, texts binary"
REQUESTS = "bucket int, chunk long, deleted boolean, grams binary, counts binary"
ANSWERS = "chunk long, bucket int, counts binary, left_out binary, n_words long, n_tokens long, n_left_out long"
SCORES = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _chunks(size: int):
    """Rows (id, text, learnt, deleted) to chunk rows."""

    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 32
        held = {False: ([], [], [], 0), True: ([], [], [], 0)}

        def full(deleted: bool) -> list[tuple]:
            nonlocal number
            ids, flags, texts, _ = held[deleted]
            held[deleted] = ([], [], [], 0)
            number += 1
            sizes = np.array([len(t) for t in texts], np.int64)
            return [(number, deleted, np.array(ids, np.int64).tobytes(), bytes(flags), sizes.tobytes(),
                     int(sizes.sum()), pack(b"".join(texts)))]

        for i, text, learnt, deleted in rows:
            ids, flags, texts, words = held[deleted]
            ids.append(i or 0)
            flags.append(learnt + 2 * (i is None))
            texts.append(text)
            held[deleted] = (ids, flags, texts, words + 1 + text.count(b" ") + text.count(b"\n"))
            if held[deleted][3] >= size:
                yield full(deleted)
        for deleted in (False, True):
            if held[deleted][0]:
                yield full(deleted)

    return run


def _texts(sizes: bytes, blob: bytes) -> Iterator[bytes]:
    import zstandard

    whole, at = zstandard.ZstdDecompressor().decompress(blob), 0
    for n in np.frombuffer(sizes, np.int64).tolist():
        yield whole[at:at + n]
        at += n


def grams(texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text, and the hashes of the n-grams that end at each token: a row per
    order from 1."""
    flat, lengths = [], []
    begin = [_BEGIN] * (order - 1)
    for text in texts:
        words = text.lower().split()
        flat += begin
        flat += words
        flat.append(_END)
        lengths.append(len(words) + 1)
    h = _words.of(flat)
    n = np.array(lengths, np.int64)
    real = np.ones(len(flat), bool)
    for j in range(order - 1):
        real[np.cumsum(n + order - 1) - n - order + 1 + j] = False
    at = np.flatnonzero(real)
    out = np.empty((order, len(at)), np.uint64)
    for m in range(1, order + 1):
        key = np.full(len(at), m, np.uint64)
        for j in range(m - 1, -1, -1):
            key = (key ^ h[at - j]) * _B
            key ^= key >> np.uint64(31)
        out[m - 1] = key | np.uint64(1) if m == 1 else key & ~np.uint64(1)
    return n, out


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash, so that sorted keys lie in bucket order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _requests(order: int, buckets: int):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        for chunk, deleted, _, flags, sizes, _, blob in rows:
            n, found = grams(_texts(sizes, blob), order)
            taught = np.repeat(np.frombuffer(flags, np.uint8) & 1, n)
            keys, inverse = np.unique(found.ravel(), return_inverse=True)
            counts = np.bincount(inverse, np.tile(taught, order), len(keys)).astype(np.uint32)
            cuts = np.searchsorted(_bucket_of(keys, buckets), np.arange(buckets + 1, dtype=np.uint64))
            yield [(b, chunk, deleted, planes(keys[at:to]), narrow(counts[at:to]))
                   for b, (at, to) in enumerate(zip(cuts, cuts[1:])) if to > at]

    return run


def _answers(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the counts over all chunks, for each chunk in the order of its n-grams,
    and the part of them that is kept out; and the bucket's own totals (no chunk)."""
    asked = [from_planes(k, np.uint64) for k in group["grams"]]
    cuts = np.cumsum([len(k) for k in asked])[:-1]
    keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.concatenate([from_narrow(c) for c in group["counts"]]).astype(np.float64)
    deleted = group["deleted"].to_numpy(bool)
    total = np.bincount(inverse, counts, len(keys)).astype(np.uint64)
    out = np.bincount(inverse, counts * np.repeat(deleted, [len(k) for k in asked]), len(keys)).astype(np.uint64)
    places = np.split(inverse, cuts)
    single = (keys & np.uint64(1)).astype(bool)
    bucket = int(group["bucket"].iloc[0])
    rows = [(c, bucket, narrow(total[p]), narrow(out[p]) if d else None, 0, 0, 0)
            for c, d, p in zip(group["chunk"].tolist(), deleted, places)]
    rows.append((-1, bucket, None, None, int((total[single] > 0).sum()), int(total[single].sum()), int(out[single].sum())))
    return pd.DataFrame(rows, columns=["chunk", "bucket", "counts", "left_out", "n_words", "n_tokens", "n_left_out"])


def _looked_up(found: np.ndarray, n: np.ndarray, answers: list[np.ndarray], tokens: int):
    """Counts of every token's n-grams and of their contexts, a row per order."""
    keys, inverse = np.unique(found.ravel(), return_inverse=True)
    table = np.concatenate(answers).astype(np.float64)
    if len(table) != len(keys):
        raise RuntimeError("a chunk's answers do not fit its n-grams")
    c = table[inverse.reshape(found.shape)]
    context = np.empty_like(c)
    context[0] = tokens
    last = np.cumsum(n) - 1
    context[1:, 1:] = c[:-1, :-1]
    context[1:, last - n + 1] = c[0, last[0]] if len(last) else 0  # as many texts begin as end
    return c, context


def _estimates(c: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates of all orders, and each token's weight bucket."""
    f = np.divide(c, context, out=np.zeros_like(c), where=context > 0)
    seen = (context > 0).sum(axis=0)  # a context is seen only where all shorter ones are
    longest = np.where(seen > 0, context[np.maximum(seen - 1, 0), np.arange(c.shape[1])], 0)
    bits = np.minimum(np.frexp(longest)[1], BITS - 1)
    return f, np.where(seen > 1, (seen - 1) * BITS + bits, 0)


def _sorted_counts(answers: pd.DataFrame, column: str) -> list[np.ndarray]:
    return [from_narrow(x) for x in answers.sort_values("bucket")[column]]


def _cells(order: int, tokens: int):
    """Of a kept-out chunk: cells (bucket, octave of each estimate) with their tokens and sums."""

    def one(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for sizes, blob in zip(chunk["sizes"], chunk["texts"]):
            n, found = grams(_texts(sizes, blob), order)
            kept = [a - b for a, b in zip(_sorted_counts(answers, "counts"), _sorted_counts(answers, "left_out"))]
            f, bucket = _estimates(*_looked_up(found, n, kept, tokens))
            octave = np.where(f > 0, 1 + np.minimum(OCTAVES - 1, np.floor(-np.log2(np.where(f > 0, f, 1)))), 0).astype(np.int64)
            cell = bucket.astype(np.int64)
            for o in octave:
                cell = cell * (OCTAVES + 1) + o
            own, inverse = np.unique(cell, return_inverse=True)
            parts.append(pd.DataFrame({"cell": own, "n": np.bincount(inverse).astype(float)} | {
                f"s{m}": np.bincount(inverse, f[m]) for m in range(order)}))
        return pd.concat(parts)

    return one


def fit_weights(bucket: np.ndarray, n: np.ndarray, f: np.ndarray, order: int) -> np.ndarray:
    """Weights (buckets x (order + 1)) that make the tokens of the cells likeliest.

    ``f``: a row per cell, the uniform estimate first. A bucket whose longest seen context
    has k words mixes the first k + 2 columns; it borrows ``PRIOR`` tokens from the weights
    common to all such buckets."""

    def climb(group: np.ndarray, start: np.ndarray, prior: np.ndarray) -> np.ndarray:
        w = start
        for _ in range(ROUNDS):
            share = w[group] * f
            share *= (n / share.sum(axis=1))[:, None]
            new = prior + np.stack([np.bincount(group, s, len(w)) for s in share.T], axis=1)
            total = new.sum(axis=1, keepdims=True)
            new = np.divide(new, total, out=start.copy(), where=total > 0)
            new = np.where(start > 0, np.maximum(new, LEAST), 0)
            new /= new.sum(axis=1, keepdims=True)
            if np.abs(new - w).max() < 1e-7:
                return new
            w = new
        return w

    may = np.tril(np.ones((order, order + 1)), 1)  # by the words of the longest seen context
    common = climb(bucket // BITS, may / may.sum(axis=1, keepdims=True), np.zeros_like(may))
    start = np.repeat(common, BITS, axis=0)
    # rounded, so that the order in which cells are added up leaves no trace in the scores
    weights = np.round(climb(bucket, start, PRIOR * start), 6)
    return weights / weights.sum(axis=1, keepdims=True)


def _scores(order: int, tokens: int, words: int, weights: np.ndarray):
    def one(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for ids, flags, sizes, blob in zip(chunk["ids"], chunk["flags"], chunk["sizes"], chunk["texts"]):
            n, found = grams(_texts(sizes, blob), order)
            c, context = _looked_up(found, n, _sorted_counts(answers, "counts"), tokens)
            f, bucket = _estimates(c, context)
            w = weights[bucket]
            p = w[:, 0] / (words + 1) + (w[:, 1:] * f.T).sum(axis=1) if tokens else np.ones(c.shape[1])
            first = np.cumsum(n) - n
            parts.append(pd.DataFrame({
                "id": pd.arrays.IntegerArray(np.frombuffer(ids, np.int64).copy(), np.frombuffer(flags, np.uint8) > 1),
                "n_tokens": n, "n_known": np.add.reduceat((c[0] > 0).astype(np.int64), first),
                "train_tokens": np.full(len(n), tokens),
                "base_score": np.add.reduceat(np.log10((c[0] + 1) / (tokens + words + 1)), first),
                "score": np.add.reduceat(np.log10(p), first)}))
        return pd.concat(parts)

    return one


class Model:
    """The written chunks with their counts, totals and mixture weights."""

    def __init__(self, chunks: DataFrame, answers: DataFrame, order: int, tokens: int, words: int, weights: np.ndarray):
        self.chunks, self.answers, self.order = chunks, answers, order
        self.tokens, self.words, self.weights = tokens, words, weights

    def scores(self) -> DataFrame:
        run = _scores(self.order, self.tokens, self.words, self.weights)
        return self.chunks.groupBy("chunk").cogroup(self.answers.groupBy("chunk")).applyInPandas(run, SCORES)


def learn(docs: DataFrame, learnt: Column | None = None, text: str = "text", key: str = "doc_id",
          order: int = ORDER, chunk: int = CHUNK, deleted: int = DELETED) -> Model:
    """Counts and weights from the rows where ``learnt`` is true (all rows by default)."""
    if not 2 <= order <= 3:
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    flag = F.coalesce(learnt if learnt is not None else F.lit(True), F.lit(False))
    out = flag & (F.pmod(F.xxhash64(docs[key], F.lit("deleted")), F.lit(deleted)) == 0)
    rows = docs.select(docs[key].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"),
                       flag.alias("learnt"), out.alias("deleted"))
    chunks = materialize(map_stream(rows, _chunks(chunk), CHUNKS), "lm-chunks")
    volume = chunks.agg(F.sum("volume")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // BUCKET_BYTES))
    asked = map_stream(chunks, _requests(order, buckets), REQUESTS)
    answers = materialize(asked.groupBy("bucket").applyInPandas(_answers, ANSWERS), "lm-counts")
    words, tokens, left = (x or 0 for x in answers.where("chunk = -1").agg(
        F.sum("n_words"), F.sum("n_tokens"), F.sum("n_left_out")).first())
    answers = answers.where("chunk >= 0").select("chunk", "bucket", "counts", "left_out")
    schema = "cell long, n double, " + ", ".join(f"s{m} double" for m in range(order))
    cells = chunks.where("deleted").groupBy("chunk").cogroup(
        answers.where("left_out is not null").groupBy("chunk")).applyInPandas(_cells(order, tokens - left), schema)
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(f"s{m}").alias(f"s{m}") for m in range(order)])
    table = cells.toPandas().sort_values("cell")  # bounded by the octaves, not by the corpus
    n = table["n"].to_numpy(float)
    f = np.stack([np.full(len(n), 1 / (words + 1))] + [table[f"s{m}"].to_numpy(float) / np.maximum(n, 1) for m in range(order)], axis=1)
    weights = fit_weights(table["cell"].to_numpy(np.int64) // (OCTAVES + 1) ** order, n, f, order)
    return Model(chunks, answers.drop("left_out"), order, tokens, words, weights)


def score_documents(docs: DataFrame, learnt: Column | None = None, text: str = "text", key: str = "doc_id",
                    order: int = ORDER) -> DataFrame:
    """One row per input row: the id, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score (add-one single words) and score, both log10 of the text's
    probability."""
    return learn(docs, learnt, text, key, order).scores().withColumnRenamed("id", key)
