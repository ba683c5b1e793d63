"""SentencePiece encoding and decoding over a relational lattice.

*Words.* A text becomes its escaped form (spaces as U+2581, one in front) and is cut where
no piece can reach across: into runs (before a space, around line feeds, between letters and
symbols that no piece joins to letters) and each run into words at every pair of characters
that no piece holds - all read off the piece table. A task cuts many texts at once with
numpy (``Cutter``); distinct words are collected in Spark and encoded, however often they stand.

*Lattice.* Every word's substrings of bounded length are exploded and equi-joined to the
piece table (broadcast: its size is the vocabulary's, checked), and the matches - edges from
start to end - are grouped by word again, in the partitioning that the words already have.

*Fold.* A higher-order ``aggregate`` folds each word's edges. For unigram models it is
Viterbi: the best score up to each position and the edge that reached it. For BPE models the
encoding is not the path with the best sum, so the fold applies the edge with the best score
that joins two neighbours, leftmost first, until none does; the state is the set of
boundaries as bits of one long. Characters outside the vocabulary become byte pieces.

*Assembly.* The words of every ``SHARE``-th text, by a hash of it, are counted; the most
frequent, at most ``HOT`` and at most ``HOT_BYTES`` with their ids, are broadcast as sorted
word hashes with their ids. The share only decides which words are at hand: one pass over all
texts makes every document's ids, with holes for its other words; those are encoded by the
same lattice, come back to their documents as rows, with the words' hashes, and fill the holes. Only ids are shuffled,
no text. Words longer than ``LONGEST`` characters that have no safe cut are rare runs; they
are encoded one by one by the library inside the tasks.

Defined results: NULL and empty texts have no ids and decode to the empty text; rows that
repeat an id are encoded each; a NULL id is encoded like any other; a literal U+2581 decodes
to a space, as in the library; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.rows import id_and_text, in_lists, map_rows, map_stream
from ledgerflow.session import materialize

SPACE = "▁"
LONGEST = 60  # characters of a word in the lattice: its boundaries fit one long
HOT = 8_000_000  # words whose ids are broadcast
HOT_BYTES = 32 << 20  # and their bytes: hash, check and place, and the ids
SHARE = 8  # one text in so many is counted for the words to broadcast
_WORD_BYTES = 8 + 2 + 4
_HOLE16, _HOLE32 = 0xFFFF, 0xFFFFFFFF
_SHARES = 64  # parts that words of about the same count are taken in
WORDS_PER_TASK = 30_000  # distinct words whose edges a task groups
_WORDS_AT_ONCE = 1 << 18  # distinct words that a task counts before it hands them on
_CHARS_AT_ONCE = 1 << 19  # characters of texts that are cut together
_SEATS_AT_ONCE = 1 << 18  # documents that a task remembers to have asked for
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model file."""

    path: str | None
    pieces: tuple[tuple[str, int, float], ...]  # piece, id, score: ordinary pieces
    byte_ids: tuple[int, ...]  # by byte, or empty
    unknown: int
    bpe: bool

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm, trained = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError("only models with identity normalisation and escaped spaces")
        rows = list(enumerate(model.pieces))
        ordinary = tuple((p.piece, i, p.score) for i, p in rows if p.type == p.NORMAL)
        by_byte = {p.piece: i for i, p in rows if p.type == p.BYTE}
        names = [f"<0x{b:02X}>" for b in range(256)]
        byte_ids = tuple(by_byte[n] for n in names) if by_byte else ()
        unknown = next(i for i, p in rows if p.type == p.UNKNOWN)
        return Pieces(path, ordinary, byte_ids, unknown, trained.model_type == trained.BPE)

    @cached_property
    def inside(self) -> frozenset[tuple[str, str]]:
        """Pairs of neighbouring characters that some piece holds."""
        return frozenset(pair for p, _, _ in self.pieces for pair in zip(p, p[1:]))

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    @cached_property
    def late(self) -> frozenset[str]:
        """Pieces that begin or end a longer piece of no worse score: joining them can enable
        an edge that stands before their own by score."""
        score, out = {p: s for p, _, s in self.pieces}, set()
        for p, _, s in self.pieces:
            for n in range(1, len(p)):
                out.update(part for part in (p[:n], p[n:]) if score.get(part, float("inf")) <= s)
        return frozenset(out)

    @cached_property
    def words(self) -> re.Pattern:
        """Matches the words of an escaped text, one after another."""
        if self._across:
            return re.compile(r"(?s).+")  # pieces reach across spaces: no cut is safe
        if any("\n" in p for p, _, _ in self.pieces):
            return re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        marks, sticky = set(_PUNCTUATION), self.sticky
        esc = lambda cs: "".join(re.escape(c) for c in sorted(cs))
        mark, safe = esc(marks), esc(marks - sticky)
        not_sticky = f"(?![{esc(sticky)}])" if sticky else ""
        runs = [rf"[^{mark}{SPACE}\n]++{not_sticky}", rf"[{safe}]++{not_sticky}" if safe else "", rf"[^{SPACE}\n]+"]
        return re.compile(rf"{SPACE}*(?:" + "|".join(r for r in runs if r) + rf")|\n|{SPACE}+")

    @cached_property
    def sticky(self) -> frozenset[str]:
        """Symbols that some piece joins to letters."""
        marks = set(_PUNCTUATION)
        return frozenset(c for a, b in self.inside for c, other in ((a, b), (b, a))
                         if c in marks and other not in marks and other != SPACE)

    def split(self, text: str) -> list[str]:
        """The runs of a text - to the next space or, where safe, change of kind; joined
        they are its escaped form."""
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def chunks(self, text: str) -> list[str]:
        """A text cut before its spaces, where every run ends; ``runs_of`` the chunks, one after
        another, are the text's runs. Each is its escaped form without the space in front."""
        if not text:
            return []
        if self._across:
            return [text.replace(" ", SPACE)]
        if "  " in text or text[0] == " " or SPACE in text:
            return [c[1:] for c in _CHUNKS.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def runs_of(self, chunk: str) -> list[str]:
        return self.words.findall(SPACE + chunk)

    @cached_property
    def _across(self) -> list[tuple[str, str]]:
        return [pair for pair in self.inside if pair[1] == SPACE and pair[0] != SPACE]

    def parts(self, run: str) -> list[str]:
        """The words of a run: cut at every pair of characters that no piece holds."""
        if self.inside.issuperset(zip(run, run[1:])):
            return [run]
        cuts = [n for n, pair in enumerate(zip(run, run[1:]), 1) if pair not in self.inside]
        return [run[a:b] for a, b in zip([0, *cuts], [*cuts, len(run)])]

    @cached_property
    def cutter(self) -> Cutter:
        return Cutter(self)

    @property
    def top(self) -> int:
        """The highest id."""
        return max([self.unknown, *self.byte_ids, *(i for _, i, _ in self.pieces)])

    def long_word(self, word: str) -> list[int]:
        """The library's ids of a word too long for the lattice."""
        library = _library(self.path)
        head = library.encode("\n")  # shields the word from the space put in front of texts
        return library.encode("\n" + word.replace(SPACE, " "))[len(head):]

    @cached_property
    def _bytes(self) -> dict[int, bytes]:
        return {i: p.encode() for p, i, _ in self.pieces} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}

    def decode(self, ids) -> str:
        """The text of ids: pieces and bytes joined, without the space put in front."""
        text = b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces.load(path)


@dataclass(frozen=True)
class Cut:
    """Texts cut into words: word w is ``escaped[starts[w]:ends[w]]``, those of text t are
    ``bounds[t]`` to ``bounds[t + 1]``; ``n_runs`` by text."""

    escaped: str
    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    n_runs: np.ndarray

    def word(self, w: int) -> str:
        return self.escaped[self.starts[w]:self.ends[w]]


class Cutter:
    """``Pieces.split`` and ``Pieces.parts`` of many texts at once."""

    def __init__(self, table: Pieces):
        self.across = bool(table._across)
        lines = self.across or any("\n" in p for p, _, _ in table.pieces)
        # line feeds and symbols are as letters where pieces hold line feeds
        self.feed = sys.maxunicode + 1 if lines else ord("\n")
        self.kinds = np.zeros(128, np.uint8)  # 1: symbol, 3: symbol that pieces join to letters
        for c in "" if lines else _PUNCTUATION:
            self.kinds[ord(c)] = 3 if c in table.sticky else 1
        before, after = {}, {}
        for a, b in table.inside:
            before.setdefault(a, len(before) + 1)
            after.setdefault(b, len(after) + 1)
        self.row, self.column = np.zeros(sys.maxunicode + 1, np.int32), np.zeros(sys.maxunicode + 1, np.int32)
        for places, index, step in ((before, self.row, len(after) + 1), (after, self.column, 1)):
            for c, n in places.items():
                index[ord(c)] = n * step
        self.apart = np.ones((len(before) + 1) * (len(after) + 1), bool)
        for a, b in table.inside:
            self.apart[self.row[ord(a)] + self.column[ord(b)]] = False

    def cut(self, texts: list[str]) -> Cut:
        escaped = "".join([SPACE + t for t in texts if t]).replace(" ", SPACE)
        points = np.frombuffer(escaped.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        places = np.concatenate(([0], np.cumsum(lengths)))
        heads = places[:-1][lengths > 0]
        begins = np.ones(len(points), bool)
        if len(points):
            begins[1:] = self.apart[self.row[points[:-1]] + self.column[points[1:]]]
            begins[heads] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        runs = (lengths > 0).astype(np.int64) if self.across else self._runs(points, heads, places)
        return Cut(escaped, points, starts, ends, np.searchsorted(starts, places), runs)

    def _runs(self, points: np.ndarray, heads: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Runs by text: stretches without spaces and line feeds, their changes between letters
        and symbols before the first sticky symbol, line feeds, and spaces before line feeds or
        the end."""
        space, feed = points == ord(SPACE), points == self.feed
        kind = self.kinds[np.minimum(points, 127)]
        body = ~(space | feed)
        first = body.copy()
        first[1:] &= ~body[:-1]  # a text's first character is a space
        change = body & ~first
        change[1:] &= kind[1:] != kind[:-1]
        at = np.arange(len(points), dtype=np.int32)
        change &= np.maximum.accumulate(np.where(kind == 3, at, -1)) < np.maximum.accumulate(np.where(first, at, -1))
        closed = np.zeros(len(points), bool)
        closed[:-1] = feed[1:]
        closed[heads[1:] - 1] = True
        closed[-1:] = True
        runs = np.concatenate(([0], np.cumsum(first | change | feed | space & closed)))
        return runs[places[1:]] - runs[places[:-1]]


def _in_batches(rows: Iterator[tuple], column: int) -> Iterator[list[tuple]]:
    """Rows whose texts have about ``_CHARS_AT_ONCE`` characters, or one longer."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[column])
        if size >= _CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_words(docs: DataFrame, table_of, text: str = "text") -> DataFrame:
    """(word, n) of all texts; every task adds its words up before anything is shuffled."""

    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        cutter, seen = table_of().cutter, Counter()
        for held in _in_batches(rows, 0):
            cut = cutter.cut([t for (t,) in held])
            seen.update([cut.escaped[a:b] for a, b in zip(cut.starts.tolist(), cut.ends.tolist())])
            if len(seen) >= _WORDS_AT_ONCE:
                yield sorted(seen.items())
                seen = Counter()
        yield sorted(seen.items())

    rows = docs.select(F.coalesce(docs[text], F.lit("")).alias("text"))
    return map_stream(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lattice(words: DataFrame, table: Pieces) -> DataFrame:
    """(word, s, e, id, score, rank, late): the edges of every word - pieces, and single
    characters outside the vocabulary with a NULL id. ``rank`` counts scores from the best (0)
    on; ``late`` marks a piece that can enable a better one (``Pieces.late``).

    The exploded substrings keep the words' partitioning, so grouping them by word again
    moves nothing."""
    if len(table.pieces) >= 1 << 19:
        raise ValueError("a piece table of over half a million pieces is not broadcast")
    ranks = {score: n for n, score in enumerate(sorted({s for _, _, s in table.pieces}, reverse=True))}
    rows = words.sparkSession.createDataFrame(
        [(p, i, float(s), ranks[s], p in table.late) for p, i, s in table.pieces],
        "piece string, id int, score double, rank int, late boolean")
    start = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("s"))
    spans = start.select("word", "s", F.explode(F.sequence(
        F.col("s") + 1, F.least(F.length("word"), F.col("s") + table.longest))).alias("e"))
    spans = spans.withColumn("part", F.expr("substring(word, s + 1, e - s)"))
    edges = spans.join(F.broadcast(rows), F.col("part") == F.col("piece"), "left").where("id is not null or e = s + 1")
    return edges.select("word", "s", "e", "id", "score", "rank", "late")


def fold_bpe(edges: DataFrame) -> DataFrame:
    """(word, path): edges joined by the best score, leftmost first, until none joins two
    neighbours; bit p of the state is a boundary before character p.

    An edge travels as one long - rank, start, end, late, id from the highest bits down - so
    sorting the longs sorts by score, then start. A round goes through the sorted edges and
    joins as it goes: what a join enables begins or ends with the joined piece, so it comes
    later in the order unless the piece is ``late``; such a join ends the round (its ``keep``
    takes the GO bit, which every edge asks for). A round that kept GO found all joins."""
    packed = F.expr("""shiftleft(cast(coalesce(rank, 0) as bigint), 44) | shiftleft(cast(s as bigint), 36)
        | shiftleft(cast(e as bigint), 28) | if(late, 134217728L, 0L) | cast(coalesce(id, 134217727) as bigint)""")
    words = edges.groupBy("word").agg(F.collect_list(packed).alias("edges"))
    go = f"{1 << 62}L"
    bits = words.select("word", F.expr("""transform(sort_array(edges), x -> struct(
        cast(shiftright(x, 36) & 255 as int) as s, cast(shiftright(x, 28) & 255 as int) as e,
        cast(x & 134217727 as int) as id, (x & 134217728) <> 0 as late))""").alias("edges"))
    joins = f"""transform(filter(edges, x -> x.e > x.s + 1), x -> struct(
        shiftleft(1L, x.s) | shiftleft(1L, x.e) | {go} as ends, shiftleft(1L, x.e) - shiftleft(1L, x.s + 1) as inside,
        ~((shiftleft(1L, x.e) - shiftleft(1L, x.s + 1)) | if(x.late, {go}, 0L)) as keep))"""
    # every round but the last joins something, so a word has no more than its length; rounds
    # after one that kept GO do nothing
    joined = f"""aggregate(sequence(1, length(word)), shiftleft(1L, length(word) + 1) - 1,
        (a, n) -> if(a >= {go}, a, aggregate(joins, a | {go},
            (r, x) -> if((r & x.ends) = x.ends and bit_count(r & x.inside) = 1, r & x.keep, r))))"""
    path = """sort_array(transform(
        filter(edges, x -> (m & (shiftleft(1L, x.s) | (shiftleft(2L, x.e) - shiftleft(2L, x.s)))) = (shiftleft(1L, x.s) | shiftleft(1L, x.e))),
        x -> struct(x.s, x.e, nullif(x.id, 134217727) as id, if(x.id = 134217727, substring(word, x.s + 1, x.e - x.s), null) as ch)))"""
    # arrays of one bind what the lambdas use: the optimizer would write it out inside them
    return bits.select("word", F.expr(f"transform(transform(array({joins}), joins -> {joined}), m -> {path})[0]").alias("path"))


def fold_viterbi(edges: DataFrame, unknown_score: float) -> DataFrame:
    """(word, path): the path with the largest sum of scores, the longer last edge winning
    ties. The state holds, for each position reached, the score, start, id and character of
    the edge that reached it best; the way back is a second fold over it."""
    ch = F.expr("substring(word, s + 1, e - s)").alias("ch")
    words = edges.groupBy("word").agg(F.collect_list(F.struct(
        "e", "s", F.coalesce("score", F.lit(unknown_score)).alias("score"), "id", ch)).alias("edges"))
    best = words.select("word", F.expr("""aggregate(array_sort(edges),
        array(struct(0D as total, 0 as s, 0 as e, cast(null as int) as id, cast(null as string) as ch)),
        (a, x) -> if(size(a) = x.e,
          concat(a, array(struct(a[x.s].total + x.score as total, x.s as s, x.e as e, x.id as id, x.ch as ch))),
          if(a[x.s].total + x.score > a[x.e].total,
            concat(slice(a, 1, x.e), array(struct(a[x.s].total + x.score as total, x.s as s, x.e as e, x.id as id, x.ch as ch))),
            a)))""").alias("best"))
    return best.select("word", F.expr("""reverse(aggregate(sequence(1, length(word)),
        struct(length(word) as at, cast(array() as array<struct<s: int, e: int, id: int, ch: string>>) as path),
        (a, n) -> if(a.at = 0, a, struct(best[a.at].s as at,
          array_append(a.path, struct(best[a.at].s as s, best[a.at].e as e, best[a.at].id as id, best[a.at].ch as ch)) as path)),
        a -> a.path))""").alias("path"))


def encode_words(words: DataFrame, table: Pieces) -> DataFrame:
    """(word, ids) for distinct words of at most ``LONGEST`` characters."""
    edges = lattice(words, table)
    paths = fold_bpe(edges) if table.bpe else fold_viterbi(edges, min((s for _, _, s in table.pieces), default=0.0) - 10.0)
    if not table.byte_ids:
        return paths.select("word", F.expr(f"transform(path, x -> coalesce(x.id, {table.unknown}))").alias("ids"))
    first = table.byte_ids[0]
    if list(table.byte_ids) != list(range(first, first + 256)):
        raise ValueError("byte pieces must follow one another")
    return paths.select("word", F.expr(f"""flatten(transform(path, x -> if(x.id is not null, array(x.id),
        transform(sequence(1, octet_length(x.ch)), i -> {first} + cast(conv(substring(hex(x.ch), 2 * i - 1, 2), 16, 10) as int)))))""").alias("ids"))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd


@lru_cache(maxsize=1)
def _character_values() -> np.ndarray:
    v = np.arange(1, sys.maxunicode + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ v >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ v >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return v ^ v >> np.uint64(31)


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    factors = np.ones((2, n + 1), np.uint64)
    factors[0, 1:], factors[1, 1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
    return tuple(np.cumprod(factors, axis=1, dtype=np.uint64))


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches of characters: 64-bit sums of their values times powers of a base, and the
    highest 16 bits of a second sum."""
    values, room = _character_values()[points], 1 << max(20, len(points).bit_length())
    sums = []
    for base, value in zip(_BASES, (values, values ^ values >> np.uint64(29))):
        powers, inverse = _powers(base, room)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * powers[:len(points)], dtype=np.uint64)))
        sums.append((total[ends] - total[starts]) * inverse[starts])
    return sums[0], (sums[1] >> np.uint64(48)).astype(np.uint16)


def _hashes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    places = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return word_hashes(points, places[:-1], places[1:])


class HotWords:
    """Ids by word: sorted 64-bit hashes, 16 more bits of a second hash, and all ids end to
    end (a word's are between its place and the next), in ``kind``."""

    def __init__(self, hashes: np.ndarray, checks: np.ndarray, blob: bytes, place: np.ndarray, kind: str):
        self.hashes, self.checks, self.blob, self.place, self.kind = hashes, checks, blob, place, kind

    @staticmethod
    def sorted(hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray, place: np.ndarray) -> HotWords:
        """From words in any order: id i of the result comes from where its word's are."""
        order = np.argsort(hashes)
        sizes = np.diff(place)[order]
        new = np.concatenate(([0], np.cumsum(sizes)))
        source = np.repeat((place[:-1][order] - new[:-1]).astype(np.int32), sizes) + np.arange(new[-1], dtype=np.int32)
        return HotWords(hashes[order], checks[order], ids[source].tobytes(), new.astype(np.int32), ids.dtype.str)

    @staticmethod
    def none() -> HotWords:
        return HotWords(np.zeros(0, np.uint64), np.zeros(0, np.uint16), b"", np.zeros(1, np.int32), "<u2")

    @property
    def size(self) -> int:
        return len(self.hashes)

    @cached_property
    def ids(self) -> np.ndarray:
        return np.frombuffer(self.blob, self.kind)

    @cached_property
    def _shift(self) -> np.uint64:
        return np.uint64(64 - (self.size.bit_length() + 1))

    @cached_property
    def _first(self) -> np.ndarray:
        """Where the hashes begin whose highest bits are 0, 1, ..."""
        n = np.bincount((self.hashes >> self._shift).astype(np.int64), minlength=1 << 64 - int(self._shift))
        return np.concatenate(([0], np.cumsum(n))).astype(np.int32)

    def __reduce__(self):
        return HotWords, (self.hashes, self.checks, self.blob, self.place, self.kind)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places in the sorted hashes, -1 for words that are not there."""
        bucket = (hashes >> self._shift).astype(np.int64)
        at, end = self._first[bucket], self._first[bucket + 1]
        out = np.full(len(hashes), -1, np.int32)
        todo = np.flatnonzero(at < end)
        at, end = at[todo], end[todo]
        while len(todo):
            same = (self.hashes[at] == hashes[todo]) & (self.checks[at] == checks[todo])
            out[todo[same]] = at[same]
            at += 1
            more = ~same & (at < end)
            todo, at, end = todo[more], at[more], end[more]
        return out

    def get(self, word: str) -> bytes | None:
        """The word's packed ids, or None."""
        at = int(self.find(*_hashes_of([word]))[0])
        return None if at < 0 else self.ids[self.place[at]:self.place[at + 1]].astype("<u4").tobytes()


def hot_words(words: DataFrame, known: DataFrame, most: int, most_bytes: int = HOT_BYTES) -> HotWords:
    """Ids of the most frequent words, at most ``most`` and at most ``most_bytes``: the words
    in the highest classes of log-scaled counts that fit together, and of the first class
    that does not fit the share by word hash that fits. ``known`` may hold the counts. The driver sees one row per class
    and share, then the hashes and ids of those words."""
    tier = F.floor(F.log2("n") * 16).cast("int")
    share = F.pmod(F.xxhash64("word"), F.lit(_SHARES))
    counted = known if "n" in known.columns else words.join(known, "word")
    sized = counted.select("word", "ids", tier.alias("tier"), share.alias("share"))
    classes = sized.groupBy("tier", "share").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids"), F.max(F.array_max("ids")).alias("top"))
    classes = classes.orderBy(F.desc("tier"), "share").collect()
    kind = np.dtype("<u2" if max((r["top"] for r in classes), default=0) < _HOLE16 else "<u4")
    left, room, least = most, most_bytes, None
    for r in classes:
        left, room = left - r["n"], room - _WORD_BYTES * r["n"] - kind.itemsize * r["ids"]
        if left < 0 or room < 0:
            break
        least = r["tier"], r["share"]
    if least is None:
        return HotWords.none()

    def hashed(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        for some in in_lists(rows, 1 << 14):
            h, check = _hashes_of([w for w, _ in some])
            yield list(zip(h.view(np.int64).tolist(), check.tolist(), [np.array(ids, kind).tobytes() for _, ids in some]))

    chosen = sized.where((F.col("tier") > least[0]) | (F.col("tier") == least[0]) & (F.col("share") <= least[1])).select("word", "ids")
    table = map_stream(chosen, hashed, "h long, c int, ids binary").toArrow()
    ids = table["ids"].combine_chunks()
    if not len(ids):
        return HotWords.none()
    place = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
    blob = np.frombuffer(ids.buffers()[2], np.uint8)[:place[-1]]
    return HotWords.sorted(table["h"].to_numpy().view(np.uint64), table["c"].to_numpy().astype(np.uint16),
                           blob.view(kind), place // kind.itemsize)


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str | None = None, hot: int = HOT,
           hot_bytes: int = HOT_BYTES, share: int = SHARE) -> DataFrame:
    """One row per input row: the id, ids (little-endian unsigned 32-bit, as the library's
    ids in order), n_runs and decoded (the ids turned back into text)."""
    spark, path = docs.sparkSession, model or default_model()
    table = pieces(path)

    def table_of() -> Pieces:
        return pieces(path)

    counted = docs.where(F.pmod(F.xxhash64(docs[text]), F.lit(share)) == 0)
    words = materialize(count_words(counted, table_of, text).where(F.length("word") <= LONGEST), "piece-words")
    # a word's edges are many times the word: partitions hold a bounded number of words
    n_words = words.count()
    parts = max(1, -(-n_words // WORDS_PER_TASK))
    dealt = words.repartition(parts, "word")
    known = materialize(encode_words(dealt.select("word"), table).join(dealt, "word"), "piece-ids")
    shared = spark.sparkContext.broadcast(hot_words(words, known, hot, hot_bytes))

    wide = table.top >= _HOLE16  # ids travel as 16 or 32 bits; the highest value is a hole
    width, hole, lowest = ("<u4", _HOLE32, 0) if wide else ("<u2", _HOLE16, 1 << 15)

    def with_holes(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        import pyarrow as pa

        table, own = table_of(), shared.value
        cutter, zstd = table.cutter, pa.Codec("zstd", compression_level=3)
        ids = np.append(own.ids.astype(width), np.array([hole], width))
        sizes = np.append(np.diff(own.place), 1)  # -1, a word that is not there: a hole

        def coded(held: list[tuple]) -> list[tuple]:
            cut = cutter.cut([t for _, t, _ in held])
            at = own.find(*word_hashes(cut.points, cut.starts, cut.ends))
            size, place = sizes[at], own.place[at]
            long = {int(w): np.array(table.long_word(cut.word(w)), width)
                    for w in np.flatnonzero(cut.ends - cut.starts > LONGEST)}
            for w, found in long.items():
                size[w] = len(found)
                place[w] = -1
            new = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
            source = np.repeat(place - new[:-1], size) + np.arange(new[-1])
            out = ids[np.where(source < len(ids), source, 0)] if long else ids[source]
            for w, found in long.items():
                out[new[w]:new[w + 1]] = found
            missing = np.flatnonzero(at < 0)
            missing = [w for w in missing.tolist() if w not in long] if long else missing
            names = [cut.escaped[a:b] for a, b in zip(cut.starts[missing].tolist(), cut.ends[missing].tolist())]
            of = np.searchsorted(missing, cut.bounds).tolist()
            first = new[cut.bounds].tolist()
            return [(i, seat, n, (b - a) * out.itemsize, zstd.compress(out[a:b], asbytes=True), names[c:d])
                    for (i, _, seat), n, a, b, c, d in zip(held, cut.n_runs.tolist(), first, first[1:], of, of[1:])]

        for held in _in_batches(rows, 1):
            yield coded(held)

    def asked_by(rows: Iterator[tuple]) -> Iterator[tuple]:
        """The words of every document; rows of the same seat and words ask once or a few times."""
        seen = set()
        for _, seat, _, _, _, missing in rows:
            words = tuple(dict.fromkeys(missing))
            if words and (seat, hash(words)) not in seen:
                if len(seen) >= _SEATS_AT_ONCE:
                    seen.clear()
                seen.add((seat, hash(words)))
                yield from ((seat, w) for w in words)

    def complete():
        import pyarrow as pa

        table, zstd = table_of(), pa.Codec("zstd", compression_level=3)

        def one(i, n_runs: int, size: int, packed: bytes, missing: list[str], found) -> tuple:
            ids = np.frombuffer(zstd.decompress(packed, size), width).astype("<u4")
            if missing:
                extra = {f["h"]: np.array(f["ids"], np.int64) + lowest for f in found}
                missing = [_signed(xxhash.xxh64_intdigest(w, 42)) for w in missing]
                places = np.flatnonzero(ids == hole)
                sizes = np.ones(len(ids), np.int64)
                sizes[places] = [len(extra[w]) for w in missing]
                filled = np.repeat(ids, sizes)
                filled[np.repeat(ids == hole, sizes)] = np.concatenate([extra[w] for w in missing])
                ids = filled.astype("<u4")
            return i, n_runs, ids.tobytes(), table.decode(ids.tolist())

        return one

    # a row's seat is where its words come back to: equal only for rows of the same id and
    # text, or by a collision, of which each row asks for its own words
    rows = id_and_text(docs, text, key)
    held = map_stream(rows.withColumn("seat", F.xxhash64("id", "text")), with_holes,
                      "id long, seat long, n_runs long, size long, packed binary, missing array<string>").repartition("seat")
    # the same rows twice, of the same columns, so that they are made and dealt out once; all
    # texts have at most ``share`` times the distinct words of an even share of them
    parts = max(parts * share, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = map_stream(held, lambda rows: in_lists(asked_by(rows)), "own_seat long, word string")
    asked = asked.where("own_seat is not null and word is not null").repartition(parts, "word")
    others = asked.groupBy("word").agg(F.max("own_seat").alias("seat")).where("seat is not null").select("word")
    if n_words > shared.value.size:  # some counted words are not broadcast, but encoded
        met = others.join(known, "word", "left_anti")
        ids_of = encode_words(met, table).unionByName(known.select("word", "ids"))
    else:
        ids_of = encode_words(others, table)
    small = "ids" if wide else f"transform(ids, i -> cast(i - {lowest} as short))"
    found = asked.join(ids_of, "word").select("own_seat", F.xxhash64("word").alias("h"), F.expr(small).alias("ids")).repartition("own_seat")
    found = found.groupBy("own_seat").agg(F.collect_list(F.struct("h", "ids")).alias("found"))
    done = held.join(found, F.col("seat") == F.col("own_seat"), "left").select("id", "n_runs", "size", "packed", "missing", "found")
    return map_rows(done, complete, "id long, n_runs long, ids binary, decoded string").withColumnRenamed("id", key)
