"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit tells the languages with a 1
from those with a 0. A bit classifier is linear in the frequencies of hashed character
trigrams (letters lower-cased, everything else one space): its weights are the log ratio of
the two sides' trigram probabilities, and a logistic scale and offset make its margin a log
odds. A text goes to the codeword with the smallest loss, each bit's logistic loss weighted
by how well that bit did on its training sample; a small lead over the next codeword is
flagged as ambiguous.

Up to ``EXHAUSTIVE`` languages get the exhaustive code (all two-way splits of the
languages); more get a random code of about 10 log2(n) bits, the best of fixed seeds by its
smallest codeword distance.

The model is fitted on at most about ``SAMPLE`` texts of every language, chosen by a hash of
the id, however many values the language column holds. Trigram counts and bit weights are
worked out in Spark, a group of trigrams at a time; the driver sees one total per language,
DIMS packed weights per bit (10 log2 of the languages) and the margins of at most about
``CALIBRATED`` sampled texts for the logistic maps. Whole texts are scored.

Defined results: NULL texts and texts without a letter are ``und`` with score 0 and are not
ambiguous; with one language all texts with letters get it; with none they are ``und``;
rows that repeat an id are returned each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.logistic import scale_and_offset
from ledgerflow.llm.rows import map_rows
from ledgerflow.llm.sampling import sample_every_class
from ledgerflow.session import materialize

DIMS = 1 << 16
SAMPLE = 1500  # texts per language that the model is fitted on
CALIBRATED = 50_000  # of these, texts that the bits' logistic maps and weights are fitted on
GROUPS = 256  # groups of trigrams whose weights are worked out together
_ROWS = 1 << 14  # counts added up at once
EXHAUSTIVE = 6
SMOOTH = 0.5
LEAD = 0.2  # a smaller lead of the best codeword's share is ambiguous
_PAIRS = 1 << 26  # pairs of codewords compared in the search for a code
_HELD = 100  # languages whose counts a task holds at once
_AT_ONCE = 1 << 20  # characters whose trigrams are looked up at once


def _letter_table() -> np.ndarray:
    """Code point -> the code point for letters of the basic plane, 32 for the rest."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


_letters: np.ndarray | None = None


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Trigram numbers of a text, a bounded number at a time; nothing without letters."""
    global _letters
    if _letters is None:
        _letters = _letter_table()
    for at in range(0, len(text), _AT_ONCE):
        piece = " " + text[max(0, at - 1):at + _AT_ONCE].lower() + " "
        c = _letters[np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4")]
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # runs of non-letters are one space
        c = c[keep]
        if len(c) < 3:
            continue
        h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
        yield (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)


def code(n: int) -> np.ndarray:
    """``n`` codewords of -1 and 1."""
    if n <= EXHAUSTIVE:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s] or [(0,)]
        words = np.array([[1 if i in s else -1 for s in splits] for i in range(n)])
        return words.reshape(n, -1)
    bits, best, most = int(np.ceil(10 * np.log2(n))), None, -1
    seeds = min(200, _PAIRS // n ** 2)
    for seed in range(max(1, seeds)):
        words = np.random.default_rng(seed).choice([-1, 1], (n, bits))
        words = words[:, np.abs(words.sum(0)) < n]  # a bit must tell something apart
        if seeds <= 1:
            return words.astype(np.int8)  # too many pairs to compare codes by: the first one
        one = words.astype(np.float32)
        gap = ((words.shape[1] - one @ one.T) / 2 + np.eye(n) * bits).min()
        if gap > most:
            best, most = words, gap
    return best.astype(np.int8)


class Codes:
    """The fitted model: languages, codewords, trigram weights, bit scales and weights."""

    def __init__(self, languages, words, weights, scale, offset, trust):
        self.languages, self.words, self.weights = languages, words, weights
        self.scale, self.offset, self.trust = scale, offset, trust
        self._ones = (words == 1).astype(np.float64)

    def margins(self, text: str) -> np.ndarray | None:
        total, n = np.zeros(self.words.shape[1]), 0
        for grams in trigrams(text):
            total += self.weights[grams].sum(axis=0, dtype=np.float64)
            n += len(grams)
        return total / n if n else None

    def shares(self, margins: np.ndarray) -> np.ndarray:
        """Each language's share by its codeword's weighted loss."""
        odds = margins * self.scale + self.offset
        yes, no = np.logaddexp(0.0, -odds) * self.trust, np.logaddexp(0.0, odds) * self.trust
        loss = no.sum() + self._ones @ (yes - no)
        share = np.exp(loss.min() - loss)
        return share / share.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        margins = self.margins(text) if text and self.languages else None
        if margins is None:
            return "und", 0.0, False
        share = self.shares(margins)
        best = int(np.argmax(share))
        lead = share[best] - np.delete(share, best).max(initial=0.0)
        return self.languages[best], float(share[best]), bool(lead < LEAD)


def bit_weights(counts: DataFrame, languages: list[str], totals: np.ndarray, words: np.ndarray) -> np.ndarray:
    """DIMS x bits: the log ratio of the trigram's mean probability in the languages with a 1
    to that in those with a 0, from (lang, gram, n) counts and their totals.

    Trigrams are worked in ``GROUPS`` groups; a group's counts are added up in one order, so
    the weights do not depend on how the rows are spread."""
    one, zero = words == 1, words == -1
    told = zero.any(axis=0)  # with one language no bit tells anything
    n_one, n_zero = one.sum(axis=0), np.maximum(zero.sum(axis=0), 1)
    below = totals + SMOOTH * DIMS
    base_one, base_zero = (SMOOTH / below) @ one, (SMOOTH / below) @ zero

    def log_ratio(sum_one: np.ndarray, sum_zero: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            ratio = np.log((base_one + sum_one) / n_one) - np.log((base_zero + sum_zero) / n_zero)
        return np.where(told, ratio, 0.0).astype(np.float32)

    place = {l: i for i, l in enumerate(languages)}

    def weigh(part: pd.DataFrame) -> pd.DataFrame:
        of, gram = part["lang"].map(place).to_numpy(), part["gram"].to_numpy()
        order = np.lexsort((of, gram))
        of, gram, n = of[order], gram[order], part["n"].to_numpy()[order]
        grams, at = np.unique(gram, return_inverse=True)
        sums = np.zeros((2, len(grams), words.shape[1]))
        for k in range(0, len(of), _ROWS):
            own, share = of[k:k + _ROWS], (n[k:k + _ROWS] / below[of[k:k + _ROWS]])[:, None]
            np.add.at(sums[0], at[k:k + _ROWS], share * one[own])
            np.add.at(sums[1], at[k:k + _ROWS], share * zero[own])
        return pd.DataFrame({"gram": grams, "weights": [w.tobytes() for w in log_ratio(*sums)]})

    weights = np.tile(log_ratio(0.0, 0.0), (DIMS, 1))
    found = counts.groupBy((F.col("gram") % GROUPS).alias("part")).applyInPandas(weigh, "gram int, weights binary").toArrow()
    for gram, packed in zip(found["gram"].to_numpy(), found["weights"]):
        weights[gram] = np.frombuffer(packed.as_buffer(), np.float32)
    return weights


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE,
        calibrated: int = CALIBRATED, at_least: int = 1) -> Codes:
    """A model from the given labelled rows (rows without text or language are not used), of
    at most about ``sample`` texts of every language. In a column of stray values each value
    is a language; ``at_least`` leaves out those with fewer labelled texts."""
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"), docs[lang].cast("string").alias("lang"))
    rows = materialize(sample_every_class(
        rows.where("lang is not null and text is not null"), "lang", "id", sample, at_least), "lang-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}

        def rest() -> Iterator[pd.DataFrame]:
            for l, total in totals.items():
                gram = np.flatnonzero(total)
                yield pd.DataFrame({"lang": l, "gram": gram.astype(np.int32), "n": total[gram]})
            totals.clear()

        for batch in batches:
            for t, l in zip(batch["text"], batch["lang"]):
                if l not in totals and len(totals) >= _HELD:
                    yield from rest()
                into = totals.setdefault(l, np.zeros(DIMS))
                for grams in trigrams(t):
                    into += np.bincount(grams, minlength=DIMS)
        yield from rest()

    counts = rows.mapInPandas(count, "lang string, gram int, n double").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "lang-counts")
    sums = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    if not sums:
        return Codes([], np.zeros((0, 0)), np.zeros((DIMS, 0)), np.zeros(0), np.zeros(0), np.zeros(0))
    languages, words = [l for l, _ in sums], code(len(sums))
    weights, bits = bit_weights(counts, languages, np.array([n for _, n in sums]), words), words.shape[1]
    model = Codes(languages, words, weights, np.ones(bits), np.zeros(bits), np.ones(bits))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(l, m.tobytes()) for t, l in zip(batch["text"], batch["lang"]) if (m := model.margins(t)) is not None]
            yield pd.DataFrame(found, columns=["lang", "margins"])

    some, n = rows, rows.count()
    if n > calibrated:
        some = rows.where(F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(1 << 20)) < int(calibrated / n * (1 << 20)))
    seen = some.mapInPandas(measure, "lang string, margins binary").toPandas()  # the bounded sample
    margins = np.frombuffer(b"".join(seen["margins"]), np.float64).reshape(-1, bits)
    of = np.searchsorted(languages, seen["lang"])
    # margins come in any order; sums over them are made in one
    order = np.lexsort((*margins.T, of))
    margins, of = margins[order], of[order]
    for b in range(bits):
        y = (words[of, b] == 1).astype(float)
        if len(y) and 0 < y.mean() < 1:
            model.scale[b], model.offset[b] = scale_and_offset(margins[:, b], y)
            odds = margins[:, b] * model.scale[b] + model.offset[b]
            wrong = ((odds > 0) != (y > 0)).mean()
            model.trust[b] = max(0.0, 1.0 - 2.0 * wrong)
    model.trust /= model.trust.sum() or 1.0
    model.trust *= bits
    return model


def predict(docs: DataFrame, model: Codes, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: the id, lang_pred, score (the codeword's share), ambiguous."""

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    out = map_rows(rows, lambda: lambda i, t: (i, *model.predict(t)), "id long, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", key)
