"""Hierarchical multi-length packing of tokenised documents.

Every task tokenises its documents and packs them in groups of about ``GROUP`` tokens:

1. *Route*: whole windows of the longest tier are cut off a long document; what remains
   goes to the smallest context tier that holds it.
2. *Pack each tier*, longest first: a window takes its tier's longest waiting remainder,
   then *fills its gap from the shorter tiers* - the longest that fits, again and again -
   and closes a last gap with the head of one shorter remainder, whose rest waits on in its
   own tier. A window is closed only when it is exactly full.
3. What cannot fill a window of its tier moves down to shorter windows; the few tokens
   that remain go on to the next group, and at the end of the task into windows of
   descending powers of two. Every window is a power of two, so none needs padding.
4. *Balance*: windows of a group, longest first, are dealt to steps of ``STEP`` tokens;
   powers of two in descending order fill each step exactly.

Tokens never leave the task that made them and no row is shuffled; a task holds one group
of ids. Results are deterministic for a given input partitioning, so a task that is run
again after a lost executor repeats its rows.

Token ids of white-space separated chunks are remembered per worker: the tokenizer drops
white space and splits at it before any merge, so a document's ids are its chunks' ids in
order, and a plain Latin chunk's ids are those of its lower-cased runs. A run is one unit of
the tokenizer's split and is unchanged by its normalizer, so its ids come from the model
alone (all tested against whole-text encoding).

Defined results: a NULL or empty text is the end token alone; rows that repeat an id are
packed each; a NULL id is packed like any other; a document of any length is cut into as
many windows as it needs; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerflow.llm.rows import id_and_bytes, map_stream

TIERS = (4096, 2048, 1024, 512)
STEP = 16 * 4096  # tokens in a step group
GROUP = 1 << 20  # tokens packed together
END_ID = 2
CHUNKS_KEPT = 1_000_000  # chunks whose ids a worker remembers

# a chunk of ASCII and Latin letters without apostrophes: the tokenizer lower-cases it and
# splits it into runs of letters, single digits and runs of other marks
_LATIN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F"
_PLAIN = re.compile(f"[!-&(-~{_LATIN}]+")
_RUNS = re.compile(f"[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+")
_PROBES = ("the", "internationally", "qzxwvkj", "\u00e9t\u00e9", "stra\u00dfe", "\u0142\u00f3d\u017a", "7", "!", "...", "({[<=>]})", "\u00f1\u0101\u017f")

SCHEMA = ("id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, window int, tier int, step_id long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Known(dict):
    """Ids by chunk and by run; what is missing is worked out and remembered."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self[chunk] = self.learn(chunk)
        return ids


def _byte_symbols() -> list[str]:
    """The character that stands for a byte in byte-level models: printable bytes for
    themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class ChunkEncoder:
    """Ids (little-endian unsigned 32-bit) of texts, chunk by chunk."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.symbols = dict(enumerate(_byte_symbols()))
        # runs skip the normalizer and the splitter, which leave them as they are, where the
        # model alone gives the same ids
        self.by_model = all(self._merged(r.encode()) == self._whole(r) for r in _PROBES)
        self.known = _Known(self._learn)

    def encode(self, text: bytes) -> bytes:
        if len(self.known) > CHUNKS_KEPT:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, text.split()))

    def _learn(self, chunk: bytes) -> bytes:
        """Ids of a new chunk: a plain one's from its runs, of which only new ones are encoded."""
        if chunk.isalpha():  # ASCII letters alone
            run = chunk.lower()
            return self._run(run) if run == chunk else self.known[run]
        text = chunk.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return self._whole(text)
        runs = _RUNS.findall(text.lower())
        if len(runs) == 1 and runs[0] == text:
            return self._run(chunk)
        return b"".join([self.known[r.encode()] for r in runs])

    def _run(self, run: bytes) -> bytes:
        return self._merged(run) if self.by_model else self._whole(run.decode())

    def _merged(self, run: bytes) -> bytes:
        text = run.decode("latin-1")
        ids = [t.id for t in self.tokenize(text if run.isascii() else text.translate(self.symbols))]
        return pack_ids(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


class _Rest:
    """What of a document is not yet placed."""

    __slots__ = ("doc", "start", "length")

    def __init__(self, doc: int, start: int, length: int):
        self.doc, self.start, self.length = doc, start, length

    def head(self, length: int) -> tuple[int, int, int]:
        piece = (self.doc, self.start, length)
        self.start += length
        self.length -= length
        return piece


class _Tier:
    """Waiting remainders of one tier, by length."""

    def __init__(self):
        self.lengths: list[int] = []
        self.rests: list[_Rest] = []
        self.tokens = 0

    def add(self, rest: _Rest) -> None:
        at = bisect_right(self.lengths, rest.length)
        self.lengths.insert(at, rest.length)
        self.rests.insert(at, rest)
        self.tokens += rest.length

    def take(self, most: int) -> _Rest | None:
        """The longest that is no longer than ``most``."""
        at = bisect_right(self.lengths, most) - 1
        if at < 0:
            return None
        self.tokens -= self.lengths.pop(at)
        return self.rests.pop(at)


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS, last: bool = True):
    """Windows [(window, tier, [(doc, start, length)])] and the remainders left over.

    All windows are exactly full. ``last``: place everything, in ever shorter windows;
    otherwise fewer tokens than the shortest tier stay over."""
    tiers = tuple(sorted(tiers, reverse=True))
    waiting = {t: _Tier() for t in tiers}
    windows = []

    def route(rest: _Rest) -> None:
        if rest.length:
            waiting[min(t for t in tiers if t >= rest.length)].add(rest)

    for doc, length in enumerate(lengths):
        rest = _Rest(doc, 0, length)
        while rest.length >= tiers[0]:
            windows.append((tiers[0], tiers[0], [rest.head(tiers[0])]))
        route(rest)

    def fill(window: int, tier: int, sources: tuple[int, ...]) -> None:
        gap, pieces = window, []
        while gap:
            # longer tiers first; each gives its longest remainder that fits
            rest = next((r for s in sources if (r := waiting[s].take(gap))), None)
            if rest is None:  # all that wait are longer than the gap: cut a head off the shortest
                own = next(s for s in reversed(sources) if waiting[s].lengths)
                rest = waiting[own].take(waiting[own].lengths[0])
            pieces.append(rest.head(min(gap, rest.length)))
            gap -= pieces[-1][2]
            route(rest)
        windows.append((window, tier, pieces))

    for n, tier in enumerate(tiers):
        below = tiers[n:]
        # as many windows as the tier has long remainders to open, while all can be filled
        while waiting[tier].lengths and sum(waiting[s].tokens for s in below) >= tier:
            fill(tier, tier, below)
    # remainders longer than the windows that the rest can still fill
    for n, tier in enumerate(tiers):
        while sum(w.tokens for w in waiting.values()) >= tier:
            fill(tier, tier, tiers)
    if last:
        while left := sum(w.tokens for w in waiting.values()):
            window = 1 << (left.bit_length() - 1)
            fill(window, tiers[-1], tiers)
    return windows, [(r.doc, r.start, r.length) for w in waiting.values() for r in w.rests]


def _packer(path: str, tiers: tuple[int, ...], step: int, group: int, end_id: int, with_ids: bool):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        encode, end = encoder(path).encode, pack_ids("<I", end_id)
        context = TaskContext.get()
        counter = (context.partitionId() if context else 0) << 32
        steps = counter
        held: list[tuple] = []  # (id, ids, where they begin in the document, its length)
        tokens = 0

        def flush(last: bool) -> list[tuple]:
            nonlocal held, tokens, counter, steps
            windows, left = pack([len(ids) // 4 for _, ids, _, _ in held], tiers, last)
            windows.sort(key=lambda w: -w[0])
            out, filled = [], 0
            for window, tier, pieces in windows:
                if filled + window > step:
                    steps, filled = steps + 1, 0
                filled += window
                offset = 0
                for doc, start, length in pieces:
                    i, ids, begin, total = held[doc]
                    own = ids[4 * start:4 * (start + length)]
                    out.append((i, begin + start, length, own if with_ids else None, zlib.crc32(own), total,
                                counter, offset, window, tier, steps))
                    offset += length
                counter += 1
            steps += 1
            held = [(held[d][0], held[d][1][4 * s:4 * (s + n)], held[d][2] + s, held[d][3]) for d, s, n in left]
            tokens = sum(len(ids) // 4 for _, ids, _, _ in held)
            return out

        for i, text in rows:
            ids = encode(text) + end
            held.append((i, ids, 0, len(ids) // 4))
            tokens += len(ids) // 4
            if tokens >= group:
                yield flush(False)
        if held:
            yield flush(True)

    return run


def pack_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None,
                   tiers: tuple[int, ...] = TIERS, step: int = STEP, group: int = GROUP,
                   end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: the id, start, length, ids (little-endian unsigned 32-bit; NULL
    unless ``with_ids``), ids_crc32, doc_tokens, sequence_id, offset, window, tier, step_id.

    ``tokenizer``: a file that every executor has; the public word-level BPE by default."""
    if any(t & (t - 1) for t in tiers) or step % max(tiers):
        raise ValueError("tiers must be powers of two and a step a multiple of the longest")
    run = _packer(tokenizer or default_tokenizer(), tuple(tiers), step, group, end_id, with_ids)
    return map_stream(id_and_bytes(docs, text, key), run, SCHEMA).withColumnRenamed("id", key)
