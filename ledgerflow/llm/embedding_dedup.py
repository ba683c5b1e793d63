"""Embedding near-dedup by E8 lattice hashing.

Identical vectors are one class with a weight. In each of ``TABLES`` tables a class's unit
vector is projected at random onto ``LATTICES`` times 8 dimensions, scaled, and each eight
decoded to an E8 lattice point; the points together are its home cell. Every class also
probes the ``PROBES`` neighbouring cells that its projection leans to most. Classes of which
one probes, or shares, the other's home cell are candidates; cosines are verified in double
precision.

Ids move before vectors. Cells are first counted and fingerprinted by the ids in them; cells
of the very same classes become one unit, and each class's vector is sent once to each unit
that it is in. A cell of more than ``BLOCK`` classes is dealt into parts, and each pair of
parts is a unit of its own, so no cell is one task's. Pairs are compared inside a unit as
matrix products and never leave it: a unit returns for each class the weight of its new
links, and a spanning forest of the links it saw. A pair that several tables or cells find
is counted in one cell, the first that makes it a candidate; both ends' cells in all tables
follow from the vectors, so a unit can tell. A product within ``ROUNDING`` of the wanted
cosine is worked out again in one fixed order, so every unit judges a pair alike.

The lattice is scaled to the wanted cosine: two vectors at that cosine lie ``REACH`` apart
after projection, on average (half the smallest distance of lattice points is 0.71). At
cosine 0.95 the expected recall with the defaults is above 0.99 for 16 to 384 dimensions, at
any number of vectors, as nothing depends on it (tests measure it against brute force).

Defined results: vectors that are NULL, empty, zero, or hold a NULL, NaN or infinite
component link with nothing, not even copies; vectors of other lengths are never compared;
a NULL id is returned, and never names a component that has another id; rows that repeat an
id are vectors of their own; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, groupby, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.components import connected_components
from ledgerflow.llm.rows import map_stream
from ledgerflow.session import materialize

COSINE = 0.95
TABLES, PROBES, LATTICES = 8, 8, 2
REACH = 0.55
BLOCK = 2048
ROUNDING = 1e-9
_AT_ONCE = 1024  # classes hashed at once
_PAIRS = 1 << 16  # linked pairs looked at together


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: all (+-1, +-1, 0...) and all (+-1/2...) of even sign."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


SHORTEST = _shortest()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum: round, and where the sum is
    odd round the worst coordinate the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


class Hasher:
    """Cells of unit vectors of one length: 64-bit numbers that also tell the table."""

    def __init__(self, length: int, cosine: float, tables: int, probes: int, lattices: int):
        self.tables, self.probes, self.lattices = tables, probes, lattices
        wide = max(length, 8)
        scale = REACH / (np.sqrt(2 - 2 * cosine) * np.sqrt(8 / wide))
        self.turn = []
        for t in range(tables):
            rng = np.random.default_rng([t, length])
            base = [np.linalg.qr(rng.normal(size=(wide, 8)))[0][:length] * scale for _ in range(lattices)]
            self.turn.append((base, rng.uniform(-1, 1, (lattices, 8))))
        mix = np.random.default_rng([7, length])
        self.mix = mix.integers(1, 1 << 63, (tables, lattices, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = mix.integers(1, 1 << 63, tables, dtype=np.uint64)

    def _number(self, t: int, k: int, points: np.ndarray) -> np.ndarray:
        """A hash of lattice points (last axis), to be added over a cell's lattices."""
        whole = np.rint(points * 2).astype(np.int64).view(np.uint64) + np.uint64(1 << 20)
        whole = whole * np.uint64(0x9E3779B97F4A7C15)
        return ((whole ^ (whole >> np.uint64(31))) * self.mix[t, k]).sum(axis=-1, dtype=np.uint64)

    def _finish(self, t: int, h: np.ndarray) -> np.ndarray:
        h = h + self.salt[t]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(27))

    def cells(self, unit: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Home cell, and probed cells nearest first, of each row."""
        base, shift = self.turn[t]
        costs, numbers = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), np.uint64)
        for k in range(self.lattices):
            y = unit @ base[k] + shift[k]
            home = nearest_e8(y)
            lean = (y - home) @ SHORTEST.T
            top = np.argpartition(-lean, min(self.probes, 239), axis=1)[:, :self.probes]
            near = np.concatenate([home[:, None, :], home[:, None, :] + SHORTEST[top]], axis=1)
            # added squared distance of going to a neighbour: 2 - 2 * lean
            cost = np.concatenate([np.zeros((len(unit), 1)), 2 - 2 * np.take_along_axis(lean, top, axis=1)], axis=1)
            costs = (costs[:, :, None] + cost[:, None, :]).reshape(len(unit), -1)
            numbers = (numbers[:, :, None] + self._number(t, k, near)[:, None, :]).reshape(len(unit), -1)
        order = np.argsort(costs[:, 1:], axis=1, kind="stable")[:, :self.probes] + 1
        cells = self._finish(t, np.concatenate([numbers[:, :1], np.take_along_axis(numbers, order, axis=1)], axis=1))
        return cells[:, 0], cells[:, 1:]


@lru_cache(maxsize=64)
def hasher(length: int, cosine: float, tables: int, probes: int, lattices: int) -> Hasher:
    return Hasher(length, cosine, tables, probes, lattices)


def _units(vectors: list[bytes]) -> np.ndarray:
    v = np.stack([np.frombuffer(x, "<f8") for x in vectors])
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame, column: str, key: str) -> DataFrame:
    """(class, vector as doubles, weight, least id) of the distinct usable vectors."""
    usable = F.expr("""vector is not null and size(vector) > 0
        and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))
        and exists(vector, x -> x != 0)""")
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[column].cast("array<double>").alias("vector"))
    return rows.where(usable).groupBy("vector").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))


def _keys(parameters: tuple):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        def hashed(held: list[tuple]) -> list[tuple]:
            out = []
            for _, same in groupby(sorted(held, key=lambda r: len(r[1])), key=lambda r: len(r[1])):
                same = list(same)
                unit = _units([v for _, v in same])
                h = hasher(unit.shape[1], *parameters)
                for t in range(h.tables):
                    home, probes = h.cells(unit, t)
                    for (c, _), own, near in zip(same, home.view(np.int64).tolist(), probes.view(np.int64).tolist()):
                        out.append((c, own, True))
                        out += [(c, n, False) for n in near]
            return out

        held = []
        for row in rows:
            held.append(row)
            if len(held) >= _AT_ONCE:
                yield hashed(held)
                held = []
        if held:
            yield hashed(held)

    return run


class _Held:
    """Units held together, so that the cells of all their linked classes are worked out at
    once: ids, weights and unit vectors side by side, linked pairs by unit."""

    def __init__(self, parameters: tuple):
        self.cosine, self.hashing = parameters[0], parameters
        self.ids, self.weight, self.unit, self.pairs = [], [], [], []
        self.rows = self.linked = 0

    def add(self, cells: list[int], rows: list[tuple], low: int, high: int) -> None:
        """One unit: the cells it stands for and its classes of one vector length."""
        part = np.array([r[3] for r in rows])
        unit = _units([r[6] for r in rows])
        a = np.flatnonzero(part == low)
        b = a if low == high else np.flatnonzero(part == high)
        i, j = self._links(unit, a, b)
        if low == high:
            i, j = i[i < j], j[i < j]
        if len(i):
            self.pairs.append((np.array(cells, np.int64), i + self.rows, j + self.rows))
            self.ids += [r[4] for r in rows]
            self.weight += [r[5] for r in rows]
            self.unit.append(unit)
            self.rows += len(rows)
            self.linked += len(i)

    def _links(self, unit: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(a), 256):
            cos = unit[a[at:at + 256]] @ unit[b].T
            i, j = np.nonzero(cos >= self.cosine - ROUNDING)
            unsure = np.flatnonzero(cos[i, j] < self.cosine + ROUNDING)
            i, j = a[at:at + 256][i], b[j]
            keep = np.ones(len(i), bool)
            keep[unsure] = (unit[i[unsure]] * unit[j[unsure]]).sum(axis=1) >= self.cosine
            found.append((i[keep], j[keep]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2

    def results(self) -> list[tuple]:
        """(class, root, NULL) of the units' spanning forests, (class, NULL, weight) of the
        links counted here."""
        if not self.pairs:
            return []
        ids, weight, unit = np.array(self.ids, np.int64), np.array(self.weight, np.int64), np.concatenate(self.unit)
        h = hasher(unit.shape[1], *self.hashing)
        in_links = np.unique(np.concatenate([x for _, i, j in self.pairs for x in (i, j)]))
        place = np.zeros(len(ids), np.int64)
        place[in_links] = np.arange(len(in_links))
        cells = [tuple(c.view(np.int64) for c in h.cells(unit[in_links], t)) for t in range(h.tables)]

        def first(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Whether a pair is a candidate, and the first cell that makes it one: a home
            they share, or the home of one that the other probes (of two the smaller id's)."""
            some, cell = np.zeros(len(i), bool), np.zeros(len(i), np.int64)
            open_ = np.arange(len(i))
            for home, probes in cells:
                a, b = place[i[open_]], place[j[open_]]
                same = home[a] == home[b]
                to_a = same | (probes[b] == home[a][:, None]).any(axis=1)
                to_b = same | (probes[a] == home[b][:, None]).any(axis=1)
                use_a = to_a & (~to_b | (ids[i[open_]] <= ids[j[open_]]))
                hit = to_a | to_b
                some[open_[hit]] = True
                cell[open_[hit]] = np.where(use_a, home[a], home[b])[hit]
                open_ = open_[~hit]
            return some, cell

        out, total = [], np.zeros(len(ids), np.int64)
        for own, i, j in self.pairs:
            start, end = min(i.min(), j.min()), max(i.max(), j.max()) + 1
            label = np.arange(end - start)
            for at in range(0, len(i), _PAIRS):
                p, q = i[at:at + _PAIRS], j[at:at + _PAIRS]
                some, cell = first(p, q)
                p, q, here = p[some], q[some], np.isin(cell[some], own)
                label = _forest(label, p - start, q - start)
                np.add.at(total, p[here], weight[q[here]])
                np.add.at(total, q[here], weight[p[here]])
            moved = np.flatnonzero(label != np.arange(len(label)))
            out += [(a, b, None) for a, b in zip(ids[start + moved].tolist(), ids[start + label[moved]].tolist())]
        some = np.flatnonzero(total)
        return out + [(c, None, n) for c, n in zip(ids[some].tolist(), total[some].tolist())]


def _forest(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the smallest position that each is connected to) after more links."""
    label = label.copy()
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _compare(parameters: tuple):
    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        # rows: (unit, low, high, part, class, weight, vector, cells), a unit's cells first
        held: dict[int, _Held] = {}
        for (unit, low, high), own in groupby(rows, key=lambda r: r[:3]):
            cells = [unit]
            for size, same in groupby(own, key=lambda r: len(r[6]) if r[6] is not None else None):
                same = list(same)
                if size is None:
                    cells = same[0][7]
                elif len(same) > 1:
                    together = held.setdefault(size, _Held(parameters))
                    together.add(cells, same, low, high)
                    if together.rows >= _AT_ONCE or together.linked >= _PAIRS:
                        yield held.pop(size).results()
        for together in held.values():
            yield together.results()

    return run


def near_groups(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", cosine: float = COSINE,
                tables: int = TABLES, probes: int = PROBES, lattices: int = LATTICES,
                block: int = BLOCK) -> DataFrame:
    """One row per input row: the id, n_links, component_id, kept."""
    known = classes(vectors, column, key)
    known = materialize(known.withColumn("class", F.monotonically_increasing_id()), "e8-classes")
    parameters = (cosine, tables, probes, lattices)

    def packed(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        for c, weight, vector in rows:
            yield [(c, weight, np.array(vector, "<f8").tobytes())]

    flat = materialize(map_stream(known.select("class", "weight", "vector"), packed,
                                  "class long, weight long, vector binary"), "e8-vectors")
    keys = materialize(map_stream(flat.select("class", "vector"), _keys(parameters),
                                  "class long, cell long, home boolean"), "e8-keys")
    # a cell's classes as a number of them and two hashes over their ids
    cells = keys.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("home").alias("lived"),
        F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y")).where("n > 1 and lived")
    parts = F.ceil(F.col("n") / block)
    # a class is in tables * (1 + probes) cells at most, and so are cells of the same classes
    units = materialize(cells.groupBy("n", "x", "y", F.when(F.col("n") > block, F.col("cell")).alias("alone")).agg(
        F.min("cell").alias("unit"), F.collect_list("cell").alias("cells")).select("unit", "cells", parts.alias("parts")), "e8-units")
    live = keys.join(units, keys["cell"] == units["unit"]).select("unit", "parts", "class")
    live = live.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")))
    live = live.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    members = live.select("unit", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "class")
    rows = members.join(flat, "class").select("unit", "low", "high", "part", "class", "weight", "vector",
                                              F.lit(None).cast("array<long>").alias("cells"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    rows = rows.union(units.where(F.size("cells") > 1).select(
        "unit", zero, zero, none, none, none, F.lit(None).cast("binary"), "cells"))
    rows = rows.repartition("unit", "low", "high").sortWithinPartitions(
        "unit", "low", "high", F.length("vector").asc_nulls_first())
    found = materialize(map_stream(rows, _compare(parameters), "a long, b long, n long"), "e8-links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    roots = connected_components(found.where("b is not null").select("a", "b"))
    named = known.join(roots, known["class"] == roots["node"], "left").withColumn("root", F.coalesce("root", "class"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(names, "root").join(counts, "class", "left").select(
        F.col("vector").alias("own"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    ids = vectors.select(vectors[key].cast("long").alias("_id"), vectors[column].cast("array<double>").alias("_vector"))
    out = ids.join(by_class, ids["_vector"] == by_class["own"], "left")
    named_id = F.when(F.col("own").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("_id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast(T.LongType()).alias("n_links"),
        named_id.alias("component_id"),
        F.col("_id").eqNullSafe(named_id).alias("kept"),
    )
